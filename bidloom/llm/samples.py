"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Longer texts are scored like all others but not learnt from; with the number of rows this bounds what the driver holds.
LONGEST = 50_000


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, learn: Column, most: dict[int, int]) -> list[tuple[str, int]]:
    """(text, label) of at most `most[y]` documents with label y, chosen by a hash of the id among the rows of `labels` where
    `learn` holds. Labels other than the keys of `most`, null ids and null texts are left out; an id that is labelled twice has
    the larger label, and one with several texts is learnt with that of the smallest hash, so that the driver gets a row an id.
    Copies of a text are kept once, in an order that does not depend on partitions."""
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(*most) & learn).groupBy("doc_id").agg(F.max("y").alias("y")))
    chosen = None
    for y, n in most.items():
        some = rows.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        chosen = some if chosen is None else chosen.union(some)
    texts = (
        documents.select(F.col("doc_id").cast("long"), "text").filter(F.length("text") <= LONGEST)
        .join(F.broadcast(chosen), "doc_id"))  # at most sum(most) rows of two numbers
    found = {}
    texts = texts.groupBy("doc_id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    table = texts.select("text", "y", "doc_id").toArrow()
    for text, y, doc_id in zip(*(table.column(c).to_pylist() for c in ("text", "y", "doc_id"))):
        key = (text, y)
        found[key] = min(found.get(key, doc_id), doc_id)
    return sorted(found, key=lambda key: (found[key], key))
