"""Token counts of whole texts by a byte-level BPE, without making the ids of a text.

Method: texts become frequencies of pre-tokens; every distinct pre-token of the corpus is tokenised once; the counts meet
the frequencies again by block, where they are multiplied and summed.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .blocks import block_numbers, flat, grouped_texts, list_array, local_ids, pack, sums, unpack

#: Fixed value: the pattern by which byte-level BPE vocabularies of this kind split a text.
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

ENCODED = "block long, payload binary, pieces binary, first int"

#: A blank with white space on both sides (or at the end); only there a cut before a blank can change the split.
_UNSAFE = re.compile(r"\s (?:\s|\Z)")


def _special_pattern(specials: list[str]) -> re.Pattern | None:
    longest_first = sorted(specials, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if specials else None


class Splitter:
    """Pre-tokens of texts as counts of local ids; repeated chunks between blanks are split once per block."""

    def __init__(self, specials: list[str]):
        self.find = regex.compile(PRE_TOKEN).findall
        self.special = _special_pattern(specials)
        self.clear()

    def clear(self) -> None:
        self.ids = local_ids()
        self.chunks: dict[str, tuple[int, ...]] = {}

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        found = self.chunks.get(chunk)
        if found is None:
            found = self.chunks[chunk] = tuple(self.ids[x] for x in self.find(chunk))
        return found

    def _plain(self, text: str, into: dict[int, int]) -> None:
        if _UNSAFE.search(text):
            for piece, n in Counter(self.find(text)).items():
                k = self.ids[piece]
                into[k] = into.get(k, 0) + n
            return
        first, *rest = text.split(" ")
        for k in self._chunk(first):
            into[k] = into.get(k, 0) + 1
        for chunk, n in Counter(rest).items():
            for k in self._chunk(" " + chunk):
                into[k] = into.get(k, 0) + n

    def counts(self, text: str) -> dict[int, int]:
        into: dict[int, int] = {}
        if self.special is not None and self.special.search(text):
            for i, part in enumerate(self.special.split(text)):
                if i % 2:
                    k = self.ids[part]
                    into[k] = into.get(k, 0) + 1
                elif part:
                    self._plain(part, into)
        elif text:
            self._plain(text, into)
        return into


def _encoder(specials: list[str]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, numbers = Splitter(specials), block_numbers()
        block = next(numbers)
        for part, last in grouped_texts(batches, "text"):
            ids, freqs = [], []
            for text in part.column("text").to_pylist():
                counts = splitter.counts(text or "")
                k = np.fromiter(counts, np.uint32, len(counts))
                order = np.argsort(k)
                ids.append(np.diff(k[order], prepend=np.uint32(0)))
                freqs.append(np.fromiter(counts.values(), np.uint32, len(counts))[order])
            payload = pack({
                "doc_id": part.column("doc_id"), "n_bytes": part.column("n_bytes"),
                "gaps": list_array(ids, np.uint32), "freqs": list_array(freqs, np.uint32)})
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int64()), "payload": pa.array([payload], pa.binary()),
                "pieces": pa.array([None], pa.binary()), "first": pa.array([None], pa.int32())})
            if last:
                pieces = list(splitter.ids)
                for start in range(0, len(pieces), 50_000):
                    some = pack({"piece": pa.array(pieces[start:start + 50_000], pa.string())})
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array([block], pa.int64()), "payload": pa.array([None], pa.binary()),
                        "pieces": pa.array([some], pa.binary()), "first": pa.array([start], pa.int32())})
                splitter.clear()
                block = next(numbers)
    return encode


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each piece of a block's dictionary."""
    for batch in batches:
        for block, pieces, first in zip(*(batch.column(c).to_pylist() for c in ("block", "pieces", "first"))):
            part = unpack(pieces)
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(np.full(part.num_rows, block)), "pos": pa.array(np.arange(first, first + part.num_rows, dtype=np.int32)),
                "piece": part.column("piece")})


def _by_block(block: np.ndarray, pos: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Counts of a batch as lists, one row a block."""
    order = np.lexsort((pos, block))
    block, pos, n = block[order], pos[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(block) else np.empty(0, np.int64)
    cuts = first[1:]
    return pa.RecordBatch.from_pydict({
        "block": pa.array(block[first]), "pos": list_array(np.split(pos, cuts) if len(block) else [], np.int32).cast(pa.list_(pa.int32())),
        "n": list_array(np.split(n, cuts) if len(block) else [], np.int32).cast(pa.list_(pa.int32()))})


def _counter(vocabulary: str):
    """Rows arrive sorted by piece, so equal ones are neighbours and each distinct piece is tokenised once."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary)
        last, last_n = None, 0
        waiting: list[tuple[np.ndarray, ...]] = []  # until a row holds the counts of many pieces
        for batch in batches:
            runs = batch.column("piece").dictionary_encode()
            distinct = runs.dictionary.to_pylist()
            todo = [x for x in distinct if x != last]
            done = dict(zip(todo, (len(e) for e in tokenizer.encode_batch_fast(todo, add_special_tokens=False))))
            done.setdefault(last, last_n)
            sizes = np.array([done[x] for x in distinct], np.int64)
            last = distinct[-1] if distinct else last
            last_n = done[last] if distinct else last_n
            n = sizes[runs.indices.to_numpy()] if distinct else np.empty(0, np.int64)
            waiting.append((batch.column("block").to_numpy(), batch.column("pos").to_numpy(), n))
            if sum(len(w[0]) for w in waiting) >= 100_000:
                yield _by_block(*map(np.concatenate, zip(*waiting)))
                waiting = []
        if waiting:
            yield _by_block(*map(np.concatenate, zip(*waiting)))
    return count


def _finish(documents: pa.Table, pieces: pa.Table) -> pa.Table:
    pos = pieces.column("pos").combine_chunks().flatten().to_numpy()
    sizes = np.zeros(len(pos), np.int64)
    sizes[pos] = pieces.column("n").combine_chunks().flatten().to_numpy()
    out = []
    for payload in documents.column("payload").to_pylist():
        batch = unpack(payload)
        gaps, offsets = flat(batch.column("gaps"))
        freqs, _ = flat(batch.column("freqs"))
        run = np.cumsum(gaps, dtype=np.int64)
        before = np.concatenate(([0], run))[offsets[:-1]]
        ids = run - np.repeat(before, np.diff(offsets))
        out.append(pa.table({
            "doc_id": batch.column("doc_id"), "n_bytes": batch.column("n_bytes"),
            "n_tokens": pa.array(sums(sizes[ids] * freqs, offsets), pa.int64())}))
    return pa.concat_tables(out)


def special_strings(vocabulary: str) -> list[str]:
    from tokenizers import Tokenizer

    added = Tokenizer.from_file(vocabulary).get_added_tokens_decoder().values()
    for token in added:
        if token.lstrip or token.rstrip or token.single_word:
            raise ValueError(f"the added token {token.content!r} has matching rules that are not supported")
    return [token.content for token in added]


def token_counts(documents: DataFrame, vocabulary: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > `limit`) for each row of `documents(doc_id, text)`.

    `vocabulary` is the path of a byte-level BPE file (`.json`) that every worker can read; counts equal those of the
    tokenizers library without begin or end tokens. Special strings inside a text are single tokens, as is its default.
    Null texts count as empty (0 bytes, 0 tokens); null and repeated ids keep a row each; other columns are ignored; an
    empty table gives an empty result. Texts of any length are counted whole.
    """
    rows = documents.select(
        F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).alias("n_bytes"))
    encoded = materialise(rows.mapInArrow(_encoder(special_strings(vocabulary)), ENCODED), "token-blocks")
    pieces = encoded.filter("pieces IS NOT NULL").select("block", "pieces", "first").mapInArrow(_entries, "block long, pos int, piece string")
    counted = (
        pieces.repartition("piece").sortWithinPartitions("piece")
        .mapInArrow(_counter(vocabulary), "block long, pos array<int>, n array<int>"))
    payloads = encoded.filter("payload IS NOT NULL").select("block", "payload")
    return (
        payloads.groupBy("block").cogroup(counted.groupBy("block"))
        .applyInArrow(_finish, "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit))
