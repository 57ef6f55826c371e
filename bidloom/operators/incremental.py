"""Skip what has not changed and keep the state of what has succeeded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .classify import classify_filename
from .status import UNCHANGED

PATH = "file_path"
PRINT = ["file_hash", "file_size_bytes", "file_mtime"]
STATE_SCHEMA = "file_path string, file_hash string, file_size_bytes bigint, file_mtime timestamp_ntz"


def _same(files: DataFrame, state: DataFrame) -> Column:
    cond = files[PATH] == state[PATH]
    for c in PRINT:
        cond = cond & files[c].eqNullSafe(state[c])
    return cond


def changed(files: DataFrame, state: DataFrame) -> DataFrame:
    """New files and files whose hash, size or time differs. Run before any text is read."""
    return files.join(state, _same(files, state), "left_anti")


def unchanged(files: DataFrame, state: DataFrame) -> DataFrame:
    return files.join(state, _same(files, state), "left_semi")


def skip_rows(files: DataFrame, state: DataFrame, run_id: str) -> DataFrame:
    """Result rows for unchanged files: typed by file name alone, content untouched."""
    return unchanged(files, state).select(
        PATH,
        classify_filename(F.col(PATH)).alias("document_type"),
        F.lit("skipped").alias("status"),
        F.lit(UNCHANGED).alias("error"),
        *PRINT,
        F.lit(run_id).alias("run_id"),
    )


def merge_state(state: DataFrame, processed: DataFrame) -> DataFrame:
    """Only successful results replace or add state, one row a path (the newest, if a path was processed twice); nothing is evicted."""
    newest = F.max(F.struct("file_mtime", *(c for c in PRINT if c != "file_mtime"))).alias("_p")
    done = processed.where("status = 'success'").groupBy(PATH).agg(newest).select(PATH, *(F.col(f"_p.{c}").alias(c) for c in PRINT))
    old, new = state.alias("old"), done.withColumn("_in", F.lit(True)).alias("new")
    return old.join(new, PATH, "full_outer").select(
        PATH, *(F.when(F.col("new._in"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c) for c in PRINT)
    )


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """State snapshot; a missing one is an empty state."""
    try:
        return spark.read.schema(STATE_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], STATE_SCHEMA)


def write_state(state: DataFrame, folder: str, version: int | str) -> str:
    """Write a new snapshot beside the old ones; readers switch to the returned path."""
    path = f"{folder.rstrip('/')}/state-{version}"
    state.write.mode("overwrite").parquet(path)
    return path
