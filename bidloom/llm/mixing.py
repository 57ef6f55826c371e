"""Mixing sources to target weights by nested hash thresholds: histograms of token sums, no sort and no sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import materialise

#: Hash digits (hexadecimal) read at each level, and the number of levels.
DIGITS, LEVELS = 3, 4


def size_of(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """source, source_size, target: one row a source (null included), in which shares by weight are cut at `most` times a
    source's size and the excess goes to the others by weight.

    The level all uncut sources reach (target / weight) is the largest one found when the sources are cut one after another in
    the order of the level at which they fill up, so one pass over the sorted sources replaces repeated sharing. These windows
    see one row a source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sources = (
        sized.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("number", F.row_number().over(by_name))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("number") - 1) % len(weights) + 1).cast("int")).cast("double"))
        .withColumn("cap", (most * F.col("source_size")).cast("double")))
    level = (
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    return (
        sources.withColumn("level", level).withColumn("level", F.max("level").over(everything))
        .select("source", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target")))


def thresholds(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """s (the source), source_size, target, whole, prefix, budget, below, upto, rows: what decides about the documents of a source.

    The budget beyond whole copies ends in one hash bucket, which is looked at with the next digits, and so on until it holds one
    row. `prefix` is this last cell, with `below` words before it, `upto` words with it, and `rows` rows.
    """
    targets = materialise(source_targets(sized, weights, most), "targets").select(
        F.col("source").alias("s"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("whole"))
    bounds = _refined(sized, targets.filter("source_size > 0 AND target > whole * source_size").select(
        "s", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget"), F.lit(0).cast("long").alias("below")), LEVELS)
    bounds = bounds.withColumnRenamed("s", "b")
    return materialise(targets.join(bounds, F.col("s").eqNullSafe(F.col("b")), "left").drop("b"), "thresholds")


def cell_of(doc_id: Column, text: Column) -> Column:
    """The first digits of md5 of the id and the text; a null id counts as `-`, a null text is no text at all."""
    return _digits(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("-")), text), LEVELS)


def _digits(key: Column, levels: int) -> Column:
    return F.substring(F.md5(key.cast("binary")), 1, DIGITS * levels)


def _copies(cell: Column) -> Column:
    closer = (F.col("t.below") < F.col("t.budget")) & (F.col("t.upto") - F.col("t.budget") <= F.col("t.budget") - F.col("t.below"))
    extra = F.when(cell.startswith(F.col("t.prefix")), closer).otherwise(cell < F.col("t.prefix"))
    return (F.col("t.whole") + F.when(extra, 1).otherwise(0)).cast("long")


def _with_copies(rows: DataFrame, decided: DataFrame) -> DataFrame:
    """`rows(d, source, size, cell)` with how often each is taken, `copies`, and the columns of `decided`.

    Rows with the same id and text lie in one cell. If a budget ends in a cell of several rows, these are written with a number
    each, and the budget that is left is divided among them by the hash of the number, as it was among all.
    """
    joined = rows.join(decided.alias("t"), F.col("source").eqNullSafe(F.col("t.s")))
    columns = ["d", "size", *[F.col(f"t.{c}") for c in ("source_size", "target")]]
    tied = F.coalesce((F.col("t.rows") > 1) & F.col("cell").startswith(F.col("t.prefix")), F.lit(False))
    alone = joined.filter(~tied).select(*columns, _copies(F.col("cell")).alias("copies"))
    if decided.filter("rows > 1").isEmpty():
        return alone
    numbered = materialise(
        joined.filter(tied).select("d", "source", "size", F.monotonically_increasing_id().alias("number")), "tied").withColumn(
        "cell", _digits(F.col("number").cast("string"), LEVELS))
    bounds = _refined(numbered, decided.filter("rows > 1").select("s", "budget", "below"), LEVELS)
    inner = materialise(decided.select("s", "source_size", "target", "whole").join(
        bounds.withColumnRenamed("s", "b"), F.col("s").eqNullSafe(F.col("b"))).drop("b"), "tied-thresholds")
    divided = numbered.join(inner.alias("t"), F.col("source").eqNullSafe(F.col("t.s")))
    return alone.unionByName(divided.select(*columns, _copies(F.col("cell")).alias("copies")))


def _sized(documents: DataFrame) -> DataFrame:
    return materialise(
        documents.select(
            F.col("doc_id").cast("long"), F.col("source").cast("string"), size_of(F.col("text")).alias("size"),
            cell_of(F.col("doc_id"), F.col("text")).alias("cell")), "sizes")


def mix(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row of `documents(doc_id, text, source)`.

    Sources in code point order, null last, have the `weights` in turn. Each document of a source is taken
    floor(target / source_size) times, and once more where its hash lies below the source's threshold, so that the words taken
    come to the target within the words of one threshold cell. The threshold is found digit by digit: token sums by source and
    hash bucket give the bucket in which the budget ends, and only that bucket is looked at with the next digits.

    The hash is md5 of the id and the text, so reruns agree. Rows with the same id and text are told apart only if the budget ends
    among them; which of them is taken makes no difference to the result. Null and blank texts have size 0 and take 0; a source without words has target 0; null sources are a source of their own; null ids are fine;
    an empty table gives an empty result; other columns are ignored.
    """
    sized = _sized(documents)
    rows = sized.select(F.struct("doc_id", "source").alias("d"), "source", "size", "cell")
    return _with_copies(rows, thresholds(sized, weights, most)).select(
        "d.doc_id", "d.source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(documents: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The rows of `documents` that the mix takes, with all their columns and `copies`, how often each is taken (a column of that
    name is replaced). Repeated rows are taken as rows of their own; an empty table gives an empty result."""
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "copies"]).alias("d"), F.col("source").cast("string").alias("source"),
        size_of(F.col("text")).alias("size"), cell_of(F.col("doc_id"), F.col("text")).alias("cell"))
    return _with_copies(rows, thresholds(_sized(documents), weights, most)).select("d.*", "copies").filter(F.col("copies") > 0)


def _refined(rows: DataFrame, bounds: DataFrame, levels: int) -> DataFrame:
    """The cell of `rows(source, size, cell)` in which the budget of each row of `bounds(s, budget, below)` ends."""
    bounds = bounds.withColumn("prefix", F.lit(""))
    for step in range(1, levels + 1):
        bounds = materialise(_boundary(rows, bounds.select("s", "budget", "below", "prefix"), step * DIGITS), "bounds")
        if bounds.filter("rows > 1").isEmpty():
            break
    return bounds


def _boundary(sized: DataFrame, bounds: DataFrame, digits: int) -> DataFrame:
    """The bucket of `digits` hash digits in which each source's budget ends, `below` and `upto` the words before it and with it."""
    inside = sized.join(bounds, F.col("source").eqNullSafe(F.col("s")) & F.col("cell").startswith(F.col("prefix")))
    buckets = inside.groupBy("s", "budget", "below", F.substring("cell", 1, digits).alias("prefix")).agg(
        F.sum("size").alias("words"), F.count(F.when(F.col("size") > 0, 1)).alias("rows"))
    upto = F.col("below") + F.sum("words").over(Window.partitionBy("s").orderBy("prefix"))
    return (
        buckets.withColumn("upto", upto).withColumn("below", F.col("upto") - F.col("words"))
        .filter((F.col("upto") > F.col("budget")) & (F.col("below") <= F.col("budget")))
        .select("s", "budget", "prefix", "below", "upto", "rows"))
