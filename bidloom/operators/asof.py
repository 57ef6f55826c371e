"""Forward as-of match by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import BLOCK

#: Rows that a task sorts, about; larger tables are dealt to more tasks than `spark.sql.shuffle.partitions`.
TASK_ROWS = 1_000_000


def next_value(
    left: DataFrame, right: DataFrame, keys: Sequence[str], position: str, value: str, out: str, block: int = BLOCK
) -> DataFrame:
    """For each left row the first non-null right value at a strictly greater position of the same key.

    Both sides are merged and scanned once per positional block, not compared pairwise. A row that finds
    nothing in its own block takes the first value of the next block that has one, so a key of any size is
    spread over as many tasks as it has blocks. What a task sorts does not grow with the tables: the rows are counted first.
    Pass written tables (`session.materialise`), as each side is read again for that.
    """
    keys = list(keys)
    rest = [c for c in left.columns if c not in (*keys, position)]
    row = F.struct(*rest) if rest else F.struct(F.lit(0).alias("_none"))
    cut = F.expr(f"{position} div {block}").alias("_block")
    value_type = right.schema[value].dataType
    ours = left.select(*keys, position, cut, row.alias("_row"), F.lit(None).cast(value_type).alias("_value"))
    row_type = ours.schema["_row"].dataType
    theirs = right.where(F.col(value).isNotNull()).select(
        *keys, position, cut, F.lit(None).cast(row_type).alias("_row"), F.col(value).alias("_value")
    )
    tasks = max(int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(left.count() + right.count()) // TASK_ROWS))
    merged = ours.unionByName(theirs).repartition(tasks, *keys, "_block")

    # at equal positions the value comes first, so it lies behind the row and is not taken
    order = [F.col(position), F.when(F.col("_row").isNull(), 0).otherwise(1)]
    ahead = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
    scanned = merged.withColumn("_here", F.first("_value", ignorenulls=True).over(ahead)).where("_row is not null")

    blocks = merged.groupBy(*keys, "_block").agg(F.min_by("_value", F.when(F.col("_value").isNotNull(), F.col(position))).alias("_first"))
    blocks = blocks.repartition(tasks, *keys)
    later = Window.partitionBy(*keys).orderBy("_block").rowsBetween(1, Window.unboundedFollowing)
    beyond = blocks.select(*keys, "_block", F.first("_first", ignorenulls=True).over(later).alias("_beyond"))
    found = scanned.join(beyond, [*keys, "_block"])
    columns = [F.col(f"_row.{c}").alias(c) for c in rest]
    return found.select(*keys, position, *columns, F.coalesce("_here", "_beyond").alias(out))
