"""Benchmark decontamination on a positional inverted index of the training tokens."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .blocks import block_numbers, grouped_texts, local_ids, pack, unpack

#: Words of a window; an item of fewer words is one window.
WINDOW = 13
#: Positions left free between documents of a block, more than any slop.
GAP = 64
#: Bytes of benchmark text that are looked up at a time; this bounds what the driver holds and every task receives.
CHUNK_BYTES = 8 << 20

#: Separators become blanks, A-Z become a-z; all bytes of other characters are word bytes.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: Bytes of text in a block; positions of all words are held, so blocks are smaller than for counts.
BLOCK_BYTES = 6 << 20

INDEX = "block long, documents binary, postings binary"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def _indexer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers, ids = block_numbers(), local_ids()
    terms, doc_ids, hashes, starts, sizes, at = [], [], [], [], [], 0
    for part, last in grouped_texts(batches, "text", BLOCK_BYTES):
        find = ids.__getitem__
        for text in part.column("text").to_pylist():
            words = words_of(text)
            terms.append(np.fromiter(map(find, words), np.uint32, len(words)))
            starts.append(at)
            sizes.append(len(words))
            at += len(words) + GAP
        doc_ids.append(part.column("doc_id"))
        hashes.append(part.column("text_hash"))
        if last:
            documents = pack({
                "doc_id": pa.concat_arrays(doc_ids), "text_hash": pa.concat_arrays(hashes),
                "start": pa.array(starts, pa.int64()), "size": pa.array(sizes, pa.int64())})
            flat_terms = np.concatenate(terms)
            order = np.argsort(flat_terms, kind="stable")
            positions = order + GAP * np.repeat(np.arange(len(sizes)), sizes)[order]
            offsets = np.concatenate(([0], np.cumsum(np.bincount(flat_terms, minlength=len(ids)))))
            gaps = np.diff(positions, prepend=0)
            gaps[offsets[:-1]] = positions[offsets[:-1]]
            lists = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(gaps.astype(np.uint32)))
            postings = pack({"term": pa.array(list(ids), pa.binary()), "gaps": lists})
            yield pa.RecordBatch.from_pydict({
                "block": pa.array([next(numbers)], pa.int64()), "documents": pa.array([documents], pa.binary()),
                "postings": pa.array([postings], pa.binary())})
            ids = local_ids()
            terms, doc_ids, hashes, starts, sizes, at = [], [], [], [], [], 0


def positional_index(documents: DataFrame) -> DataFrame:
    """A row for each block of documents: their places, and for each distinct word the positions of all its occurrences.

    The rows are written to the shared folder. Positions run through a block, with a gap between documents.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return materialise(rows.mapInArrow(_indexer, INDEX), "positions")


class Windows:
    """The distinct windows of some items: words by number, and the items each window belongs to."""

    def __init__(self, items: list[tuple[int | None, bytes | None]]):
        ids = local_ids()
        found: dict[tuple[int, ...], set] = {}
        for item_id, text in items:
            words = [ids[w] for w in words_of(text)]
            for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
                found.setdefault(tuple(words[i:i + WINDOW]), set()).add(item_id)
        self.terms = list(ids)
        self.words = list(found)
        self.items = list(found.values())


class Block:
    """Posting lists of one block, cut down to the words of the windows."""

    def __init__(self, documents: bytes, postings: bytes, terms: list[bytes]):
        docs, lists = unpack(documents), unpack(postings)
        self.doc_id, self.text_hash = docs.column("doc_id"), docs.column("text_hash")
        self.start, self.size = docs.column("start").to_numpy(), docs.column("size").to_numpy()
        column = lists.column("gaps")
        offsets, gaps = column.offsets.to_numpy(), column.values.to_numpy()
        where = pc.index_in(pa.array(terms, pa.binary()), value_set=lists.column("term"))
        self.lists = [
            np.cumsum(gaps[offsets[k]:offsets[k + 1]], dtype=np.int64) if k is not None else np.empty(0, np.int64)
            for k in where.to_pylist()]
        self.df = np.array([len(x) for x in self.lists], np.int64)

    def phrase(self, words: tuple[int, ...]) -> np.ndarray:
        """Starts of all occurrences: the list of the rarest word, moved by its offset, met with the others by rising length."""
        order = np.argsort(self.df[list(words)], kind="stable")
        starts = self.lists[words[order[0]]] - order[0]
        for k in order[1:]:
            if not len(starts):
                break
            starts = starts[_among(starts + k, self.lists[words[k]])]
        return starts

    def near(self, words: tuple[int, ...], slop: int) -> np.ndarray:
        """Starts from which the words follow in order with at most `slop` other words in between altogether."""
        if not self.df[list(words)].all():
            return np.empty(0, np.int64)
        rare = int(np.argmin(self.df[list(words)]))
        starts, anchor = self.lists[words[0]], self.lists[words[rare]]
        at = np.searchsorted(anchor, starts + rare)
        starts = starts[(at < len(anchor)) & (anchor[np.minimum(at, len(anchor) - 1)] <= starts + rare + slop)]
        here = starts
        for k in words[1:]:
            if not len(starts):
                break
            following = self.lists[k]
            at = np.searchsorted(following, here, side="right")
            inside = at < len(following)
            starts, here = starts[inside], following[at[inside]]
        return starts[here - starts <= len(words) - 1 + slop]

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.start, positions, side="right") - 1


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.searchsorted(ordered, values)
    return ordered[np.minimum(at, len(ordered) - 1)] == values if len(ordered) else np.zeros(len(values), bool)


def _matcher(windows: Windows, slop: int | None):
    """For each document: its words, the merged spans of exact matches, the items that match exactly and those that match nearly."""
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, documents, postings in zip(*(batch.column(c).to_pylist() for c in ("block", "documents", "postings"))):
                block = Block(documents, postings, windows.terms)
                n = len(block.start)
                spans: dict[int, list[tuple[int, int]]] = {}
                items: dict[int, set] = {}
                nearly: dict[int, set] = {}
                for words, owners in zip(windows.words, windows.items):
                    if not block.df[list(words)].all():
                        continue
                    starts = block.phrase(words)
                    for doc, at in zip(block.document(starts).tolist(), starts.tolist()):
                        begin = at - int(block.start[doc])
                        spans.setdefault(doc, []).append((begin, begin + len(words)))
                        items.setdefault(doc, set()).update(owners)
                    if slop is not None:
                        for doc in block.document(block.near(words, slop)).tolist():
                            nearly.setdefault(doc, set()).update(owners)
                ids = lambda found: pa.array([list(found.get(k, ())) for k in range(n)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(np.full(n, number)), "row": pa.array(np.arange(n)), "doc_id": block.doc_id,
                    "text_hash": block.text_hash, "n_words": pa.array(block.size),
                    "spans": pa.array([[x for s in merged(spans.get(k, ())) for x in s] for k in range(n)], pa.list_(pa.int64())),
                    "items": ids(items), "near_items": ids(nearly)})
    return match


MATCHES = "block long, row long, doc_id long, text_hash long, n_words long, spans array<long>, items array<long>, near_items array<long>"


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _chunks(benchmark: DataFrame) -> Iterator[tuple[Windows, bool]]:
    """Windows of the items, some MB of text at a time, and whether more follow. The items are streamed partition by partition, and
    the driver holds one chunk."""
    rows = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary").alias("text")).filter("text IS NOT NULL")
    some, size = [], 0
    for row in rows.toLocalIterator():
        if size >= CHUNK_BYTES:
            yield Windows(some), True
            some, size = [], 0
        some.append((row["item_id"], bytes(row["text"])))
        size += len(row["text"])
    yield Windows(some), False


def matches(documents: DataFrame, benchmark: DataFrame, slop: int | None = 2) -> DataFrame:
    """block, row, doc_id, text_hash, n_words, spans, items, near_items for each row of `documents(doc_id, text)`.

    `spans` are the word numbers [begin, end, begin, end, ...] covered by windows of `benchmark(item_id, text)`, merged; `items` the
    ids of items with a window that occurs exactly; `near_items` those with a window whose words follow in order with at most
    `slop` further words in between (exact ones included; empty if `slop` is None).

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. Null and blank texts have no words and match
    nothing; null items too. Null item ids match and are listed as null; items with equal ids count as one. Repeated rows keep a
    row each. With an empty benchmark nothing matches; empty documents give an empty result. Other columns are ignored.
    """
    if slop is not None and not 0 <= slop < GAP:
        raise ValueError(f"slop has to be from 0 to {GAP - 1}, as documents of a block lie {GAP} positions apart")
    index = positional_index(documents)
    found = None
    for windows, more in _chunks(benchmark):
        part = index.mapInArrow(_matcher(windows, slop), MATCHES)
        if more:  # written now, so that the next chunk can take this one's place
            part = materialise(part, "matches")
        found = part if found is None else found.union(part)
    lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "near_items")]
    return found.groupBy("block", "row").agg(
        F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("n_words").alias("n_words"), *lists)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_hit, n_items, digest, n_near = [], [], [], []
        for spans, items, near in zip(*(batch.column(c).to_pylist() for c in ("spans", "items", "near_items"))):
            pairs = list(zip(spans[::2], spans[1::2]))
            n_hit.append(sum(b - a for a, b in merged(pairs)))
            names = sorted({"" if i is None else str(i) for i in items})
            n_items.append(len(names))
            digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
            n_near.append(len(set(near)))
        words = batch.column("n_words").to_numpy()
        hit = np.array(n_hit, np.int64)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "n_words": batch.column("n_words"), "n_hit": pa.array(hit),
            "n_items": pa.array(n_items, pa.int64()), "items_sha256": pa.array(digest, pa.string()),
            "contaminated": pa.array((hit > 0) & (20 * hit >= words)), "n_near_items": pa.array(n_near, pa.int64())})


def contamination(documents: DataFrame, benchmark: DataFrame, slop: int | None = 2) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit (words inside a matching window), n_items, items_sha256 (of the sorted ids), contaminated
    (at least one word in twenty is hit) and n_near_items for each row of `documents`; see `matches` for edge cases."""
    return matches(documents, benchmark, slop).mapInArrow(
        _summarise, "doc_id long, text_hash long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, n_near_items long")
