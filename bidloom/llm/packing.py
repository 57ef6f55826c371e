"""Best-two-fit packing of tokenised documents into sequences of a fixed number of tokens.

Pieces of one length are alike, so bins are planned on the number of pieces of each length: at most `capacity` numbers, however many
documents there are. A plan is a list of bin patterns and how often each is used. Pieces get a number among those of their length and
look their place up in the plan.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import fresh_path, materialise
from .vocabulary import byte_vocabulary

PIECES = "doc_id long, piece int, start long, length int, ids binary, part int, nth long"

#: Tokens after which a task hands its pieces on.
TOKENS_AT_ONCE = 1 << 20


class Pattern(NamedTuple):
    """A bin used `times` times; `pieces` are (length, how many of it), longest first."""

    times: int
    pieces: list[tuple[int, int]]


def _best_pair(lengths: list[int], left: dict[int, int], least: int, most: int) -> tuple[int, int] | None:
    """Two unpacked pieces with the largest sum in (least, most]; of equal sums the pair with the longest piece."""
    best, pair = least, None
    low, high = 0, bisect_right(lengths, most - 1) - 1
    while low <= high:
        a, b = lengths[low], lengths[high]
        if a + b > most or left[b] == 0 or (low == high and left[a] < 2):
            high -= 1
            continue
        if left[a] and a + b > best:
            best, pair = a + b, (b, a)
        low += 1
    return pair


class _Shelf:
    """Unpacked pieces: how many of each length, and the lengths there are."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.lengths = sorted(length for length, n in counts.items() if n)

    def fill(self, room: int) -> tuple[dict[int, int], int]:
        """Pieces for one bin, taken off the shelf, and how often more the same pieces would be taken.

        The longest unpacked piece that fits, again and again; then the shortest of them gives way to the two unpacked pieces that fill
        its place and the gap best, if they fill more than it. As unpacked pieces only get fewer, the choice stays the same as long as
        every length has the pieces that were looked at."""
        left, taken = self.left, {}
        at = len(self.lengths)
        while (at := bisect_right(self.lengths, room, 0, at) - 1) >= 0:
            length = self.lengths[at]
            n = min(left[length], room // length)
            if n:
                taken[length] = n
                left[length] -= n
                room -= n * length
        if not taken:
            return taken, 0
        looked_at = dict(taken)
        shortest = min(taken)
        pair = _best_pair(self.lengths, left, shortest, shortest + room) if room else None
        if pair:
            taken[shortest] -= 1
            left[shortest] += 1
            for length in pair:
                taken[length] = taken.get(length, 0) + 1
                looked_at[length] = looked_at.get(length, 0) + 1
                left[length] -= 1
        taken = {length: n for length, n in taken.items() if n}
        return taken, min((left[length] + n - looked_at[length]) // n for length, n in taken.items())

    def take(self, pieces: dict[int, int], times: int) -> None:
        for length, n in pieces.items():
            self.left[length] -= times * n
        if any(not self.left[length] for length in pieces):
            self.lengths = [length for length in self.lengths if self.left[length]]


def best_two_fit(counts: dict[int, int], capacity: int, reserve: int = 0) -> list[Pattern]:
    """Bins for counts[length] pieces of each length, filled one after the other by best-two-fit. Pieces of at most `reserve` tokens wait
    until the others are packed, then fill the gaps of their bins, the smallest gap first, and bins of their own.

    Each pattern is used as often as it comes up again, so it exhausts a length or nearly so, and the number of patterns follows the
    number of lengths, not the pieces."""
    if any(n and not 1 <= length <= capacity for length, n in counts.items()):
        raise ValueError("a piece has to have between 1 and `capacity` tokens")
    plan: list[tuple[int, dict[int, int]]] = []
    shelf = _Shelf({length: n for length, n in counts.items() if n > 0 and length > reserve})
    while shelf.lengths:
        pieces, again = shelf.fill(capacity)
        shelf.take(pieces, again)
        plan.append((1 + again, pieces))
    shelf = _Shelf({length: n for length, n in counts.items() if n > 0 and length <= reserve})
    if shelf.lengths:
        gap = lambda pieces: capacity - sum(length * n for length, n in pieces.items())
        open_bins, plan = sorted(plan, key=lambda bins: gap(bins[1])), []
        for times, pieces in open_bins:
            while times and shelf.lengths:
                more, again = shelf.fill(gap(pieces))
                if not more:
                    break
                again = min(again, times - 1)
                shelf.take(more, again)
                plan.append((1 + again, pieces | more))
                times -= 1 + again
            if times:
                plan.append((times, pieces))
        while shelf.lengths:
            pieces, again = shelf.fill(capacity)
            shelf.take(pieces, again)
            plan.append((1 + again, pieces))
    return [Pattern(times, sorted(pieces.items(), reverse=True)) for times, pieces in plan]


def fewest_bins(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """The plan with the fewest bins among best-two-fit with different shares of the capacity reserved."""
    least = -(-sum(length * n for length, n in counts.items()) // capacity)
    best, bins = [], None
    for reserve in (0, capacity // 6, capacity // 4, capacity // 3, capacity // 12, capacity // 24):
        plan = best_two_fit(counts, capacity, reserve)
        used = sum(p.times for p in plan)
        if bins is None or used < bins:
            best, bins = plan, used
        if bins == least:
            break
    return best


def _numbered(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length in this task, from 0; `seen` goes on."""
    order = np.argsort(lengths, kind="stable")
    of = lengths[order]
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    run = np.diff(np.append(first, len(of)))
    nth = np.empty(len(lengths), np.int64)
    nth[order] = np.arange(len(of)) - np.repeat(first, run) + seen[of]
    seen[of[first]] += run
    return nth


def _cut(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document: all full but the first."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def _tokeniser(vocabulary: str, capacity: int, end: int | None):
    tail = np.array([] if end is None else [end], np.uint32)

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_vocabulary(vocabulary)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        doc_ids: list[int | None] = []
        number: list[int] = []
        starts: list[int] = []
        lengths: list[int] = []
        ids: list[np.ndarray] = []

        def ready() -> pa.RecordBatch:
            size = np.array(lengths, np.int64)
            tokens = np.concatenate(ids).astype("<u4", copy=False)
            ends = np.concatenate(([0], np.cumsum(4 * size))).astype(np.int32)
            binary = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(tokens)])
            batch = pa.RecordBatch.from_pydict({
                "doc_id": pa.array(doc_ids, pa.int64()), "piece": pa.array(number, pa.int32()), "start": pa.array(starts, pa.int64()),
                "length": pa.array(size.astype(np.int32)), "ids": binary, "part": pa.array(np.full(len(size), part, np.int32)),
                "nth": pa.array(_numbered(size, seen))})
            for held in (doc_ids, number, starts, lengths, ids):
                held.clear()
            return batch

        waiting = 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                tokens = np.concatenate((words.encode(text.as_py() or ""), tail))
                at = 0
                for k, n in enumerate(_cut(len(tokens), capacity)):
                    doc_ids.append(doc_id)
                    number.append(k)
                    starts.append(at)
                    lengths.append(n)
                    ids.append(tokens[at:at + n])
                    at += n
                    waiting += n
                    if waiting >= TOKENS_AT_ONCE:
                        yield ready()
                        waiting = 0
        if lengths:
            yield ready()
    return tokenise


def token_pieces(documents: DataFrame, vocabulary: str, capacity: int = 1024, end: int | None = 2) -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit), and (part, nth): the number of the piece among those of its
    length in its part. Written once to the shared folder, so that all passes see the same numbers."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    made = rows.mapInArrow(_tokeniser(vocabulary, capacity, end), PIECES)
    path = fresh_path(documents.sparkSession, "token-pieces")
    made.write.option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(made.schema).parquet(path)


def _places(plan: list[Pattern]) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
    """For each length its ranges of numbers: first number, pieces a bin, first sequence, first offset."""
    ranges: dict[int, list[tuple[int, int, int, int]]] = {}
    next_of: dict[int, int] = {}
    sequence = 0
    for times, pieces in plan:
        offset = 0
        for length, n in pieces:
            first = next_of.get(length, 0)
            ranges.setdefault(length, []).append((first, n, sequence, offset))
            next_of[length] = first + times * n
            offset += n * length
        sequence += times
    return sorted(ranges.items())


def pack(documents: DataFrame, vocabulary: str, capacity: int = 1024, end: int | None = 2, carry: dict | None = None) -> DataFrame:
    """doc_id, piece, start, length, the columns of `carry`, sequence_id, offset: a row for each piece of `documents(doc_id, text)`.

    A document is its ids by the byte-level BPE file `vocabulary`, special strings in it as single tokens, then `end` (None: nothing).
    Only documents of more than `capacity` ids are cut, into pieces of `capacity`, the first of which may be shorter. Sequences are
    filled by best-two-fit over all pieces of the table (`fewest_bins`); pieces of a sequence lie side by side from offset 0.
    `carry` names columns derived from `ids` (the piece's ids, little-endian unsigned 32-bit) that go with the piece; by default the ids
    themselves. What is carried is shuffled once if the table of part sizes is too large to broadcast.

    Null and empty texts are `end` alone (without `end` they have no piece). Null ids and repeated rows are documents of their own; other
    columns are ignored; an empty table gives an empty result. Texts of any length are packed whole.

    Per task at most `capacity` counts go on; the driver gets `capacity` numbers in all and broadcasts the plan, whose size is bounded by
    the capacity and does not follow the documents.
    """
    spark = documents.sparkSession
    pieces = token_pieces(documents, vocabulary, capacity, end)
    counts = materialise(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = spark.createDataFrame(
        _places(fewest_bins(histogram, capacity)), "length int, ranges array<struct<first: long, n: int, sequence: long, offset: int>>")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    carried = {"ids": F.col("ids")} if carry is None else carry
    placed = (
        pieces.select("doc_id", "piece", "start", "length", "part", "nth", *[c.alias(name) for name, c in carried.items()])
        .join(first, ["part", "length"]).join(F.broadcast(places), "length")
        .withColumn("number", F.col("before") + F.col("nth"))
        .withColumn("r", F.element_at(F.filter("ranges", lambda r: r["first"] <= F.col("number")), -1))
        .withColumn("k", F.col("number") - F.col("r.first")))
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), *carried,
        (F.col("r.sequence") + F.expr("k div r.n")).alias("sequence_id"),
        (F.col("r.offset") + F.col("k") % F.col("r.n") * F.col("length")).cast("long").alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids, doc_ids: the packed sequences themselves, from rows of `pack` that carry `ids`. A sequence has at most as many
    pieces as tokens, so its group is bounded."""
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("held"))
    return held.select(
        "sequence_id", F.aggregate("held", F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids"),
        F.col("held.doc_id").alias("doc_ids"))
