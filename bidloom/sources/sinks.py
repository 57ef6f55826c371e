"""Result files, report documents, routing plans and table sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import basename


def _leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    found = []
    for field in schema.fields:
        here = (*path, field.name)
        found += _leaves(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
    return found


def flatten(results: DataFrame) -> DataFrame:
    """Nested structs to dotted column names; arrays stay."""
    return results.select(*(
        F.col(".".join(f"`{p}`" for p in path)).alias(".".join(path)) for path in _leaves(results.schema)
    ))


def results_path(prefix: str, run_id: str, output_format: str) -> str:
    kind = "parquet" if output_format.lower() == "parquet" else "jsonl"
    return f"{prefix.rstrip('/')}/results/results_{run_id}.{kind}"


def write_results(results: DataFrame, prefix: str, run_id: str, output_format: str) -> str:
    """Flat parquet, or JSON lines for any other format; returns the written path."""
    path = results_path(prefix, run_id, output_format)
    if output_format.lower() == "parquet":
        flatten(results).write.mode("overwrite").parquet(path)
    else:
        results.write.mode("overwrite").json(path, ignoreNullFields=False)
    return path


def json_lines(results: DataFrame) -> DataFrame:
    whole = F.struct(*(F.col(f"`{c}`") for c in results.columns))
    return results.select(F.to_json(whole, {"ignoreNullFields": "false"}).alias("value"))


def report_rows(summary: DataFrame, results: DataFrame, summary_only: bool = False) -> DataFrame:
    """Report as rows (section, value): one summary row, then one row per result unless summary only."""
    head = json_lines(summary).select(F.lit("summary").alias("section"), "value")
    if summary_only:
        return head
    return head.unionByName(json_lines(results).select(F.lit("results").alias("section"), "value"))


def write_report(report: DataFrame, path: str) -> None:
    report.write.partitionBy("section").mode("overwrite").text(path)


def moved_key(key: Column, status: Column, processed: str, error: str) -> Column:
    """Successful and partial sources go to the processed prefix, all others to the error prefix."""
    target = F.when(status.isin("success", "partial"), processed.rstrip("/")).otherwise(error.rstrip("/"))
    return F.concat(target, F.lit("/"), basename(key))


def route_sources(results: DataFrame, keys: DataFrame, processed: str, error: str) -> DataFrame:
    """Routing plan (src_key, new_key); results without a known source are left out.

    `keys` holds one row per local path, so only the results side can be skewed, which AQE splits.
    """
    return results.join(keys, "file_path").select(
        F.col("key").alias("src_key"), moved_key(F.col("key"), F.col("status"), processed, error).alias("new_key")
    )


def write_items_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("header", "true").csv(path)


def save_tables(tables: dict[str, DataFrame], path: str) -> None:
    """Write each table as a new parquet folder; bidders and items can be read without the contracts."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}")
