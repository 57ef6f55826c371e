"""File discovery, listings and fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import utc_iso
from ..functions.text import basename

PDF = "*.pdf"


def scan_files(spark: SparkSession, root: str, glob: str = PDF, max_bytes: int | None = None) -> DataFrame:
    """Files under `root` at any depth whose name fits the case-sensitive glob, as the binaryFile table.

    With `max_bytes` larger files are never opened; they come without content and with a `read_error`, which fails their document.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    )
    if max_bytes is None:
        return files
    small = files.where(F.col("length") <= max_bytes).withColumn("read_error", F.lit(None).cast("string"))
    large = files.where(F.col("length") > max_bytes).select(
        "path", "modificationTime", "length", F.lit(None).cast("binary").alias("content"),
        F.concat(F.lit("file of "), F.col("length").cast("string"), F.lit(f" bytes; at most {max_bytes} are read")).alias("read_error"))
    return small.unionByName(large)


def fingerprint(files: DataFrame) -> DataFrame:
    """binaryFile rows to (file_path, file_hash, file_size_bytes, file_mtime, file_mtime_iso), and `read_error` if there is one."""
    errors = [F.col("read_error")] if "read_error" in files.columns else []
    return files.select(
        F.col("path").alias("file_path"),
        F.sha2("content", 256).alias("file_hash"),
        F.col("length").alias("file_size_bytes"),
        F.col("modificationTime").cast("timestamp_ntz").alias("file_mtime"),
        utc_iso(F.col("modificationTime")).alias("file_mtime_iso"),
        *errors,
    )


def list_keys(listing: DataFrame, prefix: str, suffix: str = ".pdf", max_items: int | None = None) -> DataFrame:
    """Keys under a prefix with a case-insensitive suffix, in listing order; the cap is the caller's choice."""
    keys = listing.where(F.col("key").startswith(prefix) & F.lower("key").endswith(suffix)).select("key")
    return keys.orderBy("key").limit(max_items) if max_items else keys


def key_map(listing: DataFrame, local_dir: str, order: str = "key") -> DataFrame:
    """Local path -> source key. Where two keys share a base name, the last one listed wins."""
    local = F.concat(F.lit(local_dir.rstrip("/") + "/"), basename(F.col("key")))
    return listing.groupBy(local.alias("file_path")).agg(F.max_by("key", order).alias("key"))
