"""Alignment of two tokenizers over the same bytes by products of token-byte incidence matrices."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .blocks import BLOCK_BYTES, block_numbers, flat, list_array, pack, sums, unpack
from .vocabulary import byte_vocabulary

#: Bytes of text that are aligned at a time (one longer text is aligned alone), and entries of a product that are made at a time.
CHUNK_BYTES, ENTRIES = 1 << 20, 1 << 21

ALIGNED = "block long, payload binary, keys array<long>, links array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"

_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class CSR(NamedTuple):
    """A sparse matrix by rows: row i has columns indices[indptr[i]:indptr[i + 1]] with the values of the same places."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.indptr) - 1

    def transposed(self) -> CSR:
        """Rows become columns by a counting sort, which keeps their order."""
        order = np.argsort(self.indices, kind="stable")
        rows = np.repeat(np.arange(self.height), np.diff(self.indptr))
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.width))))
        return CSR(indptr, rows[order], self.data[order], self.height)


def token_bytes(lengths: np.ndarray) -> CSR:
    """Incidence of tokens (rows) and the bytes that they cover; tokens lie side by side."""
    indptr = np.concatenate(([0], np.cumsum(lengths)))
    total = int(indptr[-1])
    return CSR(indptr, np.arange(total), np.ones(total, np.int64), total)


def group_tokens(group: np.ndarray, groups: int) -> CSR:
    """Incidence of tokens (rows) and groups."""
    return CSR(np.arange(len(group) + 1), group, np.ones(len(group), np.int64), groups)


def product(a: CSR, b: CSR, most: int = ENTRIES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Entries (row, column, value) of a @ b by Gustavson's rule: row i is the sum of the rows of b that row i of a names.

    Rows are taken in blocks of about `most` terms, so memory does not follow the size of the product."""
    per_entry = np.diff(b.indptr)[a.indices]
    before = np.concatenate(([0], np.cumsum(per_entry)))[a.indptr]  # terms ahead of each row
    start = 0
    while start < a.height:
        stop = max(start + 1, int(np.searchsorted(before, before[start] + most, side="right")) - 1)
        at = slice(a.indptr[start], a.indptr[stop])
        times = per_entry[at]
        rows = np.repeat(np.repeat(np.arange(start, stop), np.diff(a.indptr[start:stop + 1])), times)
        ends = np.cumsum(times)
        place = np.arange(len(rows)) - np.repeat(ends - times, times) + np.repeat(b.indptr[:-1][a.indices[at]], times)
        columns, values = b.indices[place], np.repeat(a.data[at], times) * b.data[place]
        key = rows * b.width + columns
        if len(key) and np.any(key[1:] < key[:-1]):
            order = np.argsort(key, kind="stable")
            key, values = key[order], values[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.empty(0, np.int64)
        if len(first):
            yield key[first] // b.width, key[first] % b.width, np.add.reduceat(values, first)
        start = stop


def piece_bytes(processor) -> list[bytes]:
    """The bytes each sentencepiece id stands for: U+2581 is a blank, <0xHH> a byte."""
    pieces = [processor.id_to_piece(i) for i in range(processor.get_piece_size())]
    return [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]


class Aligned(NamedTuple):
    """Token occurrences of some texts, one text after the other, and the groups that common ends cut them into."""

    a: np.ndarray
    b: np.ndarray
    a_bytes: np.ndarray
    b_bytes: np.ndarray
    cuts: np.ndarray
    links: tuple[np.ndarray, np.ndarray]  # occurrences of a and of b whose byte ranges end together

    def groups_of(self) -> tuple[np.ndarray, np.ndarray]:
        return np.searchsorted(self.cuts, np.cumsum(self.a_bytes)), np.searchsorted(self.cuts, np.cumsum(self.b_bytes))

    def overlap_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Occurrences of a and b that share bytes, and how many."""
        return product(token_bytes(self.a_bytes), token_bytes(self.b_bytes).transposed())

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Occurrences of a and b of one group. As many as the product of its sizes, so they are made in blocks of rows."""
        of_a, of_b = self.groups_of()
        return product(group_tokens(of_a, len(self.cuts)), group_tokens(of_b, len(self.cuts)).transposed())


def align(a: np.ndarray, b: np.ndarray, a_bytes: np.ndarray, b_bytes: np.ndarray) -> Aligned:
    """Two token sequences over the same bytes. Links are the overlaps whose two ranges end at the same byte; their ends cut the groups."""
    made = Aligned(a, b, a_bytes, b_bytes, np.empty(0, np.int64), (np.empty(0, np.int64),) * 2)
    a_end, b_end = np.cumsum(a_bytes), np.cumsum(b_bytes)
    kept = []
    for i, j, _ in made.overlap_links():
        together = a_end[i] == b_end[j]
        kept.append((i[together], j[together]))
    if not kept:
        return made
    i, j = (np.concatenate(x) for x in zip(*kept))
    return made._replace(cuts=a_end[i], links=(i, j))


class Aligner:
    """Both tokenizers, the bytes of their tokens, and texts of ids for the group lists."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor

        self.words = byte_vocabulary(path_a)
        self.pieces = SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = self.words.bytes_of, piece_bytes(self.pieces)
        self.length_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.length_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.width = len(self.bytes_b)
        texts = lambda n, mark: np.array([f"{k}{mark}" for k in range(n)], object)
        self.inner_a, self.last_a = texts(len(self.bytes_a), ","), texts(len(self.bytes_a), "|")
        self.inner_b, self.last_b = texts(self.width, ","), texts(self.width, ";")

    def tokens(self, text: str | None, b: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids by both; none where a text is null or empty or either does not give back its bytes."""
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        if not text:
            return none
        whole = (" " + text).encode()
        if b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return none
        a = self.words.encode(" " + text, specials=False)
        if b"".join(map(self.bytes_a.__getitem__, a.tolist())) != whole:
            return none
        return a.astype(np.int64), np.array(b, np.int64)

    def group_texts(self, found: Aligned, a_at: np.ndarray, b_at: np.ndarray) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` for each text, whose tokens lie between neighbouring values of `a_at` and `b_at`."""
        of_a, of_b = found.groups_of()
        last = lambda of: np.concatenate((of[1:] != of[:-1], [True])) if len(of) else np.empty(0, bool)
        sizes_a, sizes_b = np.bincount(of_a, minlength=len(found.cuts)), np.bincount(of_b, minlength=len(found.cuts))
        written = np.empty(len(found.a) + len(found.b), object)
        at_a = np.arange(len(of_a)) + (np.cumsum(sizes_b) - sizes_b)[of_a]
        at_b = np.arange(len(of_b)) + np.cumsum(sizes_a)[of_b]
        written[at_a] = np.where(last(of_a), self.last_a[found.a], self.inner_a[found.a])
        written[at_b] = np.where(last(of_b), self.last_b[found.b], self.inner_b[found.b])
        bounds = (a_at + b_at).tolist()
        return ["".join(written[s:e].tolist())[:-1] for s, e in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list, int]]:
    """Ids and texts of about CHUNK_BYTES."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = value.as_py()
            ids.append(doc_id)
            texts.append(text)
            size += len(text or "")
            if size >= CHUNK_BYTES or len(ids) >= 1000:
                yield ids, texts, size
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, size


def _by_document(document: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of each of n documents in order, where each document's begin, and how often each occurs."""
    order = np.lexsort((key, document))
    document, key = document[order], key[order]
    first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (document[1:] != document[:-1])))) if len(key) else np.empty(0, np.int64)
    times = np.diff(np.append(first, len(key)))
    return key[first], np.searchsorted(document[first], np.arange(n + 1)), times


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return key, np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(key)).astype(np.int64)


def _encoder(path_a: str, path_b: str, render: Callable[[str], str]):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, numbers = _aligner(path_a, path_b), block_numbers()
        block, held, pairs = next(numbers), 0, []

        def row(payload: bytes | None, keys: np.ndarray | None, links: np.ndarray | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "block": pa.array([block], pa.int64()), "payload": pa.array([payload], pa.binary()),
                "keys": pa.array([keys], pa.list_(pa.int64())), "links": pa.array([links], pa.list_(pa.int64()))})

        def dictionary() -> Iterator[pa.RecordBatch]:
            keys, links = _merged(pairs)
            for start in range(0, len(keys), 100_000):
                yield row(None, keys[start:start + 100_000], links[start:start + 100_000])

        for ids, texts, size in _chunks(batches):
            pieces = aligner.pieces.encode([t or "" for t in texts], num_threads=1)
            both = [aligner.tokens(t, b) for t, b in zip(texts, pieces)]
            del pieces
            a_at = np.concatenate(([0], np.cumsum([len(a) for a, _ in both])))
            b_at = np.concatenate(([0], np.cumsum([len(b) for _, b in both])))
            a, b = (np.concatenate(x) for x in zip(*both))
            found = align(a, b, aligner.length_a[a], aligner.length_b[b])
            groups = [render(g) if g else "" for g in aligner.group_texts(found, a_at, b_at)]
            i, j = found.links
            document = np.searchsorted(a_at, i, side="right") - 1
            keys, offsets, times = _by_document(document, a[i] * aligner.width + b[j], len(ids))
            links = np.bincount(document, minlength=len(ids))
            cut = np.bincount(np.searchsorted(a_at, found.groups_of()[0].searchsorted(np.arange(len(found.cuts))), side="right") - 1, minlength=len(ids))
            if len(keys):
                pairs.append((keys, times))
                pairs[:] = [_merged(pairs)]
            yield row(pack({
                "doc_id": pa.array(ids, pa.int64()), "n_a": pa.array(np.diff(a_at)), "n_b": pa.array(np.diff(b_at)), "n_groups": pa.array(cut),
                "n_links": pa.array(links), "groups": pa.array(groups, pa.string()),
                "keys": list_array(np.split(keys, offsets[1:-1]), np.int64), "times": list_array(np.split(times, offsets[1:-1]), np.uint32)}),
                None, None)
            held += size
            if held >= BLOCK_BYTES:
                if pairs:
                    yield from dictionary()
                block, held, pairs = next(numbers), 0, []
        if pairs:
            yield from dictionary()
        pa.default_memory_pool().release_unused()
    return encode


def _finish(documents: pa.Table, counts: pa.Table) -> pa.Table:
    key = counts.column("key").to_numpy()
    order = np.argsort(key)
    key, count, best = key[order], counts.column("count").to_numpy()[order], counts.column("best").to_numpy()[order]
    out = []
    for payload in documents.column("payload").to_pylist():
        batch = unpack(payload)
        keys, offsets = flat(batch.column("keys"))
        times = flat(batch.column("times"))[0].astype(np.int64)
        at = np.searchsorted(key, keys)
        out.append(pa.table({
            "doc_id": batch.column("doc_id"), "n_a": batch.column("n_a"), "n_b": batch.column("n_b"), "n_groups": batch.column("n_groups"),
            "n_links": batch.column("n_links"), "n_best": pa.array(sums(times * best[at], offsets).astype(np.int64)),
            "count_sum": pa.array(sums(times * count[at], offsets).astype(np.int64)), "groups": batch.column("groups")}))
    return pa.concat_tables(out)


def aligned_blocks(documents: DataFrame, path_a: str, path_b: str, render: Callable[[str], str] = str) -> DataFrame:
    """Aligned documents as payloads of blocks, and each block's distinct linked pairs with their links; written once."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(rows.mapInArrow(_encoder(path_a, path_b, render), ALIGNED), "aligned")


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """a, b, key, count, best: links of each pair over the corpus, and whether no pair of the same b has more."""
    entries = blocks.filter("keys IS NOT NULL").select(F.inline(F.arrays_zip("keys", "links")))
    counts = entries.groupBy(F.col("keys").alias("key")).agg(F.sum("links").alias("count")).select(
        (F.expr(f"key div {width}")).cast("int").alias("a"), (F.col("key") % width).cast("int").alias("b"), "key", "count")
    counts = materialise(counts, "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "key", "count", (F.col("count") == F.col("most")).alias("best"))


def alignment(documents: DataFrame, path_a: str, path_b: str, render: Callable[[str], str] = str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups: a row for each row of `documents(doc_id, text)`.

    A blank and the text are encoded by the byte-level BPE file `path_a` (A) and the text by the sentencepiece model `path_b` (B, which
    adds the blank), without special tokens. Bytes at which tokens of both end cut the tokens into groups; links are the pairs of
    occurrences of A and B that overlap and end together; a pair of ids counts its links in the whole table. n_best: links whose count is
    the highest of their B id; count_sum: the counts of a document's links, added. `groups` is `render` of the groups' text, ids as
    `a1,a2|b1;a3|b2,b3`; by default the text itself, which is several times as long as the document.

    Texts that are null or empty, or whose tokens do not give back their bytes, have no tokens: zeros and an empty `groups`, which is
    not rendered. Null ids and repeated rows keep a row each and count like others; other columns are ignored; an empty table gives an
    empty result. Texts of any length are aligned whole.

    Blocks of documents share a table of their linked pairs; only these tables are shuffled, and the counts return to their blocks.
    """
    from sentencepiece import SentencePieceProcessor

    blocks = aligned_blocks(documents, path_a, path_b, render)
    counts = pair_counts(blocks, SentencePieceProcessor(model_file=path_b).get_piece_size())
    entries = blocks.filter("keys IS NOT NULL").select(F.col("block").alias("of"), F.explode("keys").alias("key"))
    answered = entries.join(counts.select("key", "count", "best"), "key")
    payloads = blocks.filter("payload IS NOT NULL").select("block", "payload")
    return (
        payloads.groupBy("block").cogroup(answered.groupBy("of")).applyInArrow(_finish, RESULT))
