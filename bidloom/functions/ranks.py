"""Exact running counts and quantiles whose work never gathers a whole group in one task.

A plain window or `percentile` puts each group into a single task. Here a group is cut into blocks of
bounded size, by position or by its own quantiles; only the per-block totals of a group meet, and each row
combines its block's offset with its rank inside the block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows per positional block.
BLOCK = 1 << 16
#: Blocks that a group of more than BLOCK distinct values is cut into, and the rank error of the sketch that cuts it, as a share.
PARTS, PRECISION = 256, 10_000


def running_count(
    df: DataFrame, keys: Sequence[str], position: str, flag: Column, out: str, block: int = BLOCK
) -> DataFrame:
    """Number of flagged rows of the group up to and including this row, by an integer position.

    Positions are unique within a group and dense enough that a block of `block` of them holds a
    bounded number of rows.
    """
    keys = list(keys)
    cut = df.withColumn("_block", F.expr(f"{position} div {block}")).withColumn("_hit", flag.cast("bigint"))
    totals = cut.groupBy(*keys, "_block").agg(F.sum("_hit").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_block", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, "_block").orderBy(position).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        cut.withColumn("_local", F.sum("_hit").over(inside))
        .join(offsets, [*keys, "_block"])
        .withColumn(out, F.col("_base") + F.col("_local"))
        .drop("_block", "_hit", "_base", "_local")
    )


def value_ranks(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values of each group with their ranks: (keys, _v, _n, _first, _rows). Nulls and NaN are left out.

    `_v` is the value, of any type that has an order and quantiles, `_n` its number of rows, `_first` the number of rows with a smaller
    value and `_rows` that of the group. Equal values are counted together first. A group of up to BLOCK distinct values is one block; a
    larger one is cut at PARTS quantiles of a mergeable sketch, so that no window holds more than BLOCK values or about a PARTS-th of a
    group. The sketch only decides where the cuts are: ranks are exact.
    """
    keys = list(keys)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    if isinstance(rows.schema["_v"].dataType, (T.DoubleType, T.FloatType)):
        rows = rows.where(~F.isnan("_v"))
    by = keys or ["_all"]
    if not keys:
        rows = rows.withColumn("_all", F.lit(0))
    values = rows.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    # every large group has more than BLOCK of the values, so there are few of them
    large = values.groupBy(*by).agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") > BLOCK).drop("_d")
    shares = F.array(*(F.lit(k / PARTS) for k in range(1, PARTS)))
    cuts = values.join(large, by, "left_semi").groupBy(*by).agg(F.approx_percentile("_v", shares, PRECISION).alias("_cuts"))
    block = F.coalesce(F.size(F.filter("_cuts", lambda c: c < F.col("_v"))), F.lit(0))
    dealt = values.join(cuts, by, "left").select(*by, "_v", "_n", block.alias("_block"))
    whole = Window.partitionBy(*by, "_block")
    upto = whole.orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.select(
        *by, "_block", "_v", "_n", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_below"), F.sum("_n").over(whole).alias("_here"))
    totals = values.join(cuts, by).groupBy(*by, block.alias("_block")).agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_block", F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_base"), F.sum("_t").over(Window.partitionBy(*by)).alias("_all_rows"))
    return local.join(offsets, [*by, "_block"], "left").select(
        *keys, "_v", "_n", (F.col("_below") + F.coalesce("_base", F.lit(0))).alias("_first"),
        F.coalesce("_all_rows", "_here").alias("_rows"))


def quantiles_of(ranked: DataFrame, keys: Sequence[str], probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles from `value_ranks`, with the group's row count `n`, `mean`, `lowest` and `highest`."""
    number = F.col("_v").cast("double")

    def at(rank: Column) -> Column:
        holds = (F.col("_first") <= rank) & (rank < F.col("_first") + F.col("_n"))
        return F.max(F.when(holds, number))

    aggs, outs = [], []
    for name, p in probs.items():
        place = (F.col("_rows") - 1) * F.lit(float(p))
        low = F.floor(place)
        aggs += [
            at(low).alias(f"_{name}_lo"),
            at(F.least(low + 1, F.col("_rows") - 1)).alias(f"_{name}_hi"),
            F.max(place - low).alias(f"_{name}_w"),
        ]
        weight = F.col(f"_{name}_w")
        outs.append((F.col(f"_{name}_lo") * (1 - weight) + F.col(f"_{name}_hi") * weight).alias(name))
    exact = isinstance(ranked.schema["_v"].dataType, (T.DecimalType, T.IntegralType))
    total = F.col("_v").cast("decimal(20,4)") * F.col("_n").cast("decimal(18,0)") if exact else number * F.col("_n")
    return (
        ranked.groupBy(*keys)
        .agg(F.max("_rows").alias("n"), F.sum(total).alias("_total"), F.min(number).alias("lowest"), F.max(number).alias("highest"), *aggs)
        .where(F.col("n").isNotNull())
        .select(*keys, "n", (F.col("_total").cast("double") / F.col("n")).alias("mean"), "lowest", "highest", *outs)
    )


def blocked_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact linear-interpolation quantiles for groups of any size and values of any digits; also `n`, `mean`, `lowest`, `highest`."""
    return quantiles_of(value_ranks(df, keys, value), list(keys), probs)
