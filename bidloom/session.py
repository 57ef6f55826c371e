"""Session helpers: where shared intermediate tables live and which settings the plans rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings the operators are designed for. They are Spark defaults or safe refinements of them;
#: `apply_settings` never overrides what the cluster operator has set explicitly.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    explicit = dict(spark.sparkContext.getConf().getAll())
    for key, value in RECOMMENDED.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by `spark.checkpoint.dir`.

    Only a local session may leave it out (tests): it then gets a folder in its warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, purpose: str) -> str:
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` once as a parquet table in the shared folder and read it back.

    Used where several sinks fan out from one expensive result: unlike a cache it survives the loss
    of executors without recomputing the text scan.
    """
    path = fresh_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
