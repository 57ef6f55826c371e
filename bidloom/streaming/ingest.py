"""Structured Streaming forms of the ingest: landing folder, exactly-once delivery, windowed monitoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..session import fresh_path


def landing_stream(spark: SparkSession, path: str, schema, max_files: int | None = None) -> DataFrame:
    """Parquet files arriving under `path`; `max_files` caps one micro-batch, never the whole run."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"


def run_available(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, idle: bool = True, mode: str = "append"
) -> None:
    """Process everything that has arrived, in micro-batches, then stop: the periodic batch job.

    Without `idle` only batches with new rows run. A stream with timers on the clock needs that: it always has another idle batch to
    run and would not stop; its timers are looked at whenever rows come.
    """
    conf, before = stream.sparkSession.conf, stream.sparkSession.conf.get(IDLE_BATCHES)
    conf.set(IDLE_BATCHES, "true" if idle else "false")  # a query keeps the settings of its start
    try:
        query = (
            stream.writeStream.foreachBatch(sink)
            .option("checkpointLocation", checkpoint)
            .outputMode(mode)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        conf.set(IDLE_BATCHES, before)
    query.awaitTermination()


def written(spark: SparkSession, schema, path: str) -> DataFrame:
    """Parquet written under `path`; no rows if nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def collect_batches(
    stream: DataFrame, batch: Callable[[DataFrame], DataFrame], purpose: str, home: str | None = None, idle: bool = True,
    rows_once: bool = False, mode: str = "append",
) -> DataFrame:
    """Run `batch` on every micro-batch and return the written table.

    Each batch overwrites its own folder, named by the batch id, so a batch that is run again after a
    failure replaces its first attempt instead of adding to it. With the same `home` (output and
    checkpoint) a later call takes up only what has arrived since, and the table holds the rows of all calls.
    An empty landing folder gives no rows. `idle` as in `run_available`. With `rows_once` the rows of a micro-batch are written before
    `batch` reads them, as a stateful stream needs whose rows are read more than once, and a batch without rows is left out. `mode` is
    the stream's output mode.
    """
    spark = stream.sparkSession
    home = home or fresh_path(spark, purpose)

    def write(df: DataFrame, batch_id: int) -> None:
        if rows_once:
            path = f"{home}/rows/batch={batch_id}"
            df.write.mode("overwrite").parquet(path)
            df = spark.read.schema(df.schema).parquet(path)
            if df.isEmpty():
                return
        batch(df).write.mode("overwrite").parquet(f"{home}/out/batch={batch_id}")

    run_available(stream, write, f"{home}/checkpoint", idle, mode)
    schema = batch(spark.createDataFrame([], stream.schema)).schema
    return written(spark, schema, f"{home}/out/batch=*")


def append_to_table(stream: DataFrame, purpose: str, home: str | None = None) -> DataFrame:
    """Run an append-mode stream to its end into a parquet table and return that table; `home` as in `collect_batches`."""
    spark = stream.sparkSession
    home = home or fresh_path(spark, purpose)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{home}/out")
        .option("checkpointLocation", f"{home}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return written(spark, stream.schema, f"{home}/out")


def drop_redelivered(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First delivery per key of an endless stream, within the watermark; later rows and the state of older keys are dropped.

    A periodic run, whose files may come in any order, uses `first_deliveries` instead, which drops nothing.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on the executors' disks instead of their heaps. Set before a query's first run; its checkpoint remembers it."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def first_deliveries(
    stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], keys: list[str], order: list[str], purpose: str, home: str | None = None
) -> DataFrame:
    """One row per key of everything that has arrived, whatever the order of files and batches: the first by the columns `order` (say event
    time, then file), of equal ones the least by all other columns. `prepare` has to be a streaming projection.

    The first row of each key is kept as keyed state in RocksDB, so a run costs what its own rows cost and not what came before. A
    micro-batch writes the keys it has touched; a key that is delivered again may be written again, and the least of its rows counts.
    """
    use_rocksdb(stream.sparkSession)
    rows = prepare(stream)
    rest = [c for c in rows.columns if c not in (*keys, *order)]
    first = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    touched = collect_batches(first, lambda df: df, purpose, home, mode="update")
    return touched.groupBy(*keys).agg(F.min("_first").alias("_first")).select(*keys, "_first.*").select(*rows.columns)


def window_counts(log: DataFrame, event_time: str, size: str) -> DataFrame:
    """Results, failures and processing time per type and tumbling window."""
    return (
        log.groupBy(F.window(event_time, size).alias("w"), "document_type")
        .agg(
            F.count(F.lit(1)).alias("results"),
            F.count_if(F.col("status") == "success").alias("successful"),
            F.count_if(F.col("status") == "failed").alias("failed"),
            F.sum("processing_time").alias("total_time"),
        )
        .select(F.col("w.start").alias("window_start"), "document_type", "results", "successful", "failed", "total_time")
    )


def status_by_window(stream: DataFrame, event_time: str, size: str, delay: str) -> DataFrame:
    """`window_counts` of an endless stream: a window comes out once, when it is closed; late rows are taken until `delay`.

    For a periodic run, where the windows still open count too, collect `window_counts` of the batches instead.
    """
    return window_counts(stream.withWatermark(event_time, delay), event_time, size)


def counts_from_batches(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Add up per-batch counts: batches are partial aggregates of the whole run."""
    return counts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts.columns if c not in keys))
