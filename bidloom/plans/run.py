"""One run of the pipeline: files and pages in; results, tables, routing, reports and state out."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental, load, report, validate
from ..operators.mapping import MappingConfig
from ..operators.status import UNCHANGED
from ..session import materialise
from ..sources import sinks
from ..sources.pages import documents
from ..sources.snapshots import SnapshotStore
from ..streaming.gather import whole_documents
from ..streaming.ingest import collect_batches, use_rocksdb
from .documents import process_documents
from .store import load_batch

DOCUMENT = ["file_path", "first_page", "text", "text_length", "pages_with_content", "page_count", "page_ends"]


def extract_batch(
    files: DataFrame,
    pages: DataFrame,
    run_id: str,
    state: DataFrame | None = None,
    ocr_pages: DataFrame | None = None,
    config: MappingConfig | None = None,
    alt_pages: DataFrame | None = None,
) -> DataFrame:
    """Results for files(file_path, file_hash, file_size_bytes, file_mtime) from pages(file_path, page_no, text).

    With a state, unchanged files are left out before any page text is shuffled and come back as skipped rows.
    Files without pages fail. `ocr_pages` has the same shape as `pages`, plus `ocr_method`, `ocr_duration_seconds` and, if
    OCR can fail, `ocr_error` (on any row of the file), and is used only where triage asks for it. `alt_pages` are the pages of a second
    reader, which types with a `second_text` use where the first found none. A `read_error` of a file fails its document.
    """
    todo = files if state is None else incremental.changed(files, state)
    texts = documents(pages.join(todo.select("file_path"), "file_path", "left_semi")).select(*DOCUMENT)
    docs = todo.join(texts, "file_path", "left")
    if alt_pages is not None:
        second = documents(alt_pages.join(todo.select("file_path"), "file_path", "left_semi"))
        docs = docs.join(second.select("file_path", F.col("text").alias("alt_text"), F.col("page_ends").alias("alt_page_ends")), "file_path", "left")
    if ocr_pages is not None:
        scanned = ocr_pages.join(todo.select("file_path"), "file_path", "left_semi")
        if "ocr_error" not in scanned.columns:
            scanned = scanned.withColumn("ocr_error", F.lit(None).cast("string"))
        once = scanned.groupBy("file_path").agg(
            F.max("ocr_method").alias("ocr_method"), F.max("ocr_duration_seconds").alias("ocr_duration_seconds"),
            F.max("ocr_error").alias("ocr_error"),
        )
        ocr_text = documents(scanned).select(
            "file_path", F.col("text").alias("ocr_text"), F.col("text_length").alias("ocr_text_length"),
            F.col("pages_with_content").alias("ocr_pages_with_content"), F.col("page_count").alias("ocr_page_count"),
            F.col("page_ends").alias("ocr_page_ends"),
        )
        docs = docs.join(ocr_text.join(once, "file_path"), "file_path", "left")
    results = process_documents(docs, run_id, config)
    if state is None:
        return results
    return results.unionByName(_skipped(files, state, run_id, results))


def _skipped(files: DataFrame, state: DataFrame, run_id: str, results: DataFrame) -> DataFrame:
    """Unchanged files in the shape of results."""
    rows = incremental.skip_rows(files, state, run_id)
    given = {f: F.col(f) for f in ("run_id", "file_hash", "file_size_bytes", "file_mtime")}
    meta = F.struct(*(
        given.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in results.schema["meta"].dataType.fields
    ))
    columns = {
        "file_path": F.col("file_path"),
        "file_name": F.substring_index("file_path", "/", -1),
        "document_type": F.col("document_type"),
        "status": F.lit("skipped"),
        "error": F.lit(UNCHANGED),
        "meta": meta,
    }
    return rows.select(*(columns.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in results.schema.fields))


def finish_batch(
    results: DataFrame, out: str, run_id: str, tables: dict[str, DataFrame] | None = None, output_format: str = "parquet",
    state: DataFrame | None = None, summary_only: bool = False, store: SnapshotStore | None = None,
    run_ts: datetime.datetime | None = None,
) -> dict[str, str]:
    """Write everything a run leaves behind and return the paths.

    The results are written once; every summary, table and report reads that copy instead of extracting again. With a `store` the run's
    tables, refused rows, changes and state are loaded into it in one commit, last (`load_batch`); `commit` is then its version. With
    `tables` (and `state`) new whole tables are written beside the old ones instead. Rows of contracts are stamped with `run_ts`,
    which is the present by default.
    """
    run_ts = run_ts or datetime.datetime.now(datetime.timezone.utc)
    stored = materialise(results, f"results-{run_id}")
    judged = materialise(validate.validate_results(stored), f"rules-{run_id}")
    paths = {"results": sinks.write_results(stored, out, run_id, output_format)}
    summary = report.run_summary(stored)
    paths["report"] = f"{out}/report/run_id={run_id}"
    sinks.write_report(sinks.report_rows(summary, stored, summary_only), paths["report"])
    paths["rules"] = f"{out}/rules/run_id={run_id}"
    validate.rule_table(judged).write.mode("overwrite").parquet(paths["rules"])
    paths["items_report"] = f"{out}/items_report/run_id={run_id}"
    sinks.write_items_report(report.items_report(stored), paths["items_report"])
    if tables is not None:
        paths["tables"] = f"{out}/tables/run_id={run_id}"
        loaded = load.load_tables(stored, tables, run_ts=F.lit(run_ts).cast("timestamp"))
        sinks.save_tables(loaded | {"rejected_rows": load.rejected_rows(stored)}, paths["tables"])
    if state is not None:
        done = stored.select("file_path", "status", "meta.file_hash", "meta.file_size_bytes", "meta.file_mtime")
        # last, so that a run that breaks earlier is repeated in full
        paths["state"] = incremental.write_state(incremental.merge_state(state, done), f"{out}/state", run_id)
    if store is not None:
        paths["commit"] = str(load_batch(stored, store, run_id, run_ts).version)
    return paths


def gathered_documents(rows: DataFrame) -> DataFrame:
    """Document table from rows of `whole_documents`; a document that did not become whole has no text and a `read_error`."""
    keys = ["file_path", "file_version"]
    whole = documents(rows.where("page_error is null").drop("page_error"), keys).withColumn("read_error", F.lit(None).cast("string"))
    broken = rows.where("page_error is not null").select(*keys, F.col("page_error").alias("read_error"))
    return whole.unionByName(broken, allowMissingColumns=True).withColumn(
        "file_hash", F.nullif(F.col("file_version"), F.lit(""))).drop("file_version")


def ingest_landing(
    page_stream: DataFrame, run_id: str, config: MappingConfig | None = None, home: str | None = None, hold: str | None = "1 day"
) -> DataFrame:
    """Process every page file that has landed, in micro-batches, and return the results table.

    With a column `page_count`, the pages of a document may arrive in any number of files, in any order, in this run or later ones: its
    result appears once, when the document is whole (`whole_documents`). `file_version`, if given, is the file's hash: a version that has
    been processed is not processed again when it lands anew. A document that is still not whole `hold` after its first page fails.
    Without that column a document's pages arrive in one file, hence in one micro-batch.

    With the same `home` a later call processes only files that have landed since; the table holds the results of all calls.
    """
    if "page_count" not in page_stream.columns:
        return collect_batches(page_stream, lambda pages: process_documents(documents(pages), run_id, config), "landing", home)
    use_rocksdb(page_stream.sparkSession)
    return collect_batches(
        whole_documents(page_stream, hold), lambda rows: process_documents(gathered_documents(rows), run_id, config), "landing", home,
        idle=hold is None, rows_once=True)
