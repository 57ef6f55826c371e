"""Near-duplicate groups by 64-bit SimHash fingerprints: bucketed bit-sliced comparison, then connected components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from .blocks import small
from .bitslice import linker
from .stars import components

#: Members of a bucket that are compared at once; a larger bucket is dealt by further bits until it is smaller.
BUCKET = 1024
#: Seed of XXH64 for shingles.
SEED = 42
#: Shingles whose bits are counted at a time.
COUNTED = 1 << 16


def fingerprint(text: bytes | None, width: int) -> int:
    """SimHash of a text: a bit is 1 if it is set in over half of the hashes of the shingles of `width` words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - width + 1)
    ends = ends[min(width, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    set_in = np.zeros(64, np.int64)
    for at in range(0, n, COUNTED):
        spans = zip(starts[at:min(n, at + COUNTED)].tolist(), ends[at:at + COUNTED].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], np.uint64)
        set_in += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_in > n, bitorder="little").view("<u8")[0])


def _fingerprinter(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            fps = np.array([fingerprint(t, width) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "fp": pa.array(fps.view(np.int64))})
    return run


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _pieces(bits: list[int], n: int) -> list[int]:
    """Masks of `n` near-equal consecutive parts of some bit numbers."""
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << b for b in bits[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]


def first_masks(radius: int) -> list[int]:
    """With radius + 2 parts at least two agree in any linked pair, so a bucket fixes every choice of two parts."""
    return [a | b for a, b in combinations(_pieces(list(range(64)), radius + 2), 2)]


def finer_masks(mask: int, radius: int) -> list[int]:
    """The free bits in radius + 1 parts, of which a linked pair shares at least one."""
    free = [b for b in range(64) if not mask >> b & 1]
    return [mask | part for part in _pieces(free, radius + 1)]


def _dealt(rows: DataFrame, masks) -> DataFrame:
    return rows.select("fp", F.explode(masks).alias("mask")).select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))


def _signed_array(masks: list[int]):
    return F.array(*[F.lit(_signed(m)).cast("long") for m in masks])


def links(fingerprints: DataFrame, radius: int = 3) -> DataFrame:
    """a, b: edges that connect all distinct fingerprints `fp` within `radius` differing bits (a spanning forest of each bucket).

    Buckets of over 1,024 distinct fingerprints are dealt out again by more of their bits; as fingerprints are distinct, a bucket
    with f free bits has at most 2^f members, so this ends, and no bucket of any size is dropped or compared in one task.
    """
    masks = first_masks(radius)
    rows = _dealt(fingerprints, _signed_array(masks))
    found = None
    while masks:
        sizes = rows.groupBy("mask", "key").agg(F.count("*").alias("members")).filter("members > 1")
        rows = materialise(rows.join(sizes, ["mask", "key"]).select("mask", "key", "fp", "members"), "buckets")
        here = (
            rows.filter(F.col("members") <= BUCKET).select("mask", "key", "fp").repartition("mask", "key")
            .sortWithinPartitions("mask", "key", "fp").mapInArrow(linker(radius), "a long, b long"))
        found = here if found is None else found.union(here)
        hot = rows.filter(F.col("members") > BUCKET)
        used = [r["mask"] for r in hot.select("mask").distinct().collect()]  # at most the masks of this step
        masks = [m for m in masks if _signed(m) in used]
        if masks:
            finer = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)).cast("long"), _signed_array(finer_masks(m, radius)))])
            rows = _dealt(hot.select("fp", "mask"), finer[F.col("mask")]).distinct()
            masks = sorted({x for m in masks for x in finer_masks(m, radius)})
    return found


def near_duplicates(documents: DataFrame, width: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, text_hash, fingerprint, component_id, representative for each row of `documents(doc_id, text)`.

    Words are maximal runs without ASCII white space, A-Z lower-cased; a text of fewer than `width` words is one shingle; a null
    or blank text has fingerprint 0 and links like any other. Fingerprints with at most `radius` differing bits are linked;
    `component_id` is the smallest doc_id of the connected documents (null where none of them has an id). `representative` marks
    the row with the smallest id (none comes last), fingerprint and text hash, and its exact repeats. `text_hash` is xxhash64 of the
    text; (doc_id, text_hash) tells rows apart. Repeated rows keep a row each. An empty table gives an empty result; other columns are
    ignored; texts are read whole.
    """
    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    hashed = materialise(rows.mapInArrow(_fingerprinter(width), "doc_id long, text_hash long, fp long"), "fingerprints")
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("fp"), F.col("text_hash"))
    nodes = materialise(hashed.groupBy("fp").agg(F.min(least).alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), radius))
    placed = (
        nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    groups = placed.groupBy("root").agg(F.min("least").alias("chosen"))
    grouped = placed.join(groups, "root").select("fp", "chosen")
    return hashed.join(grouped, "fp").select(
        "doc_id", "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("chosen.doc_id").alias("component_id"),
        F.col("chosen").eqNullSafe(least).alias("representative"))
