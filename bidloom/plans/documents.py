"""Documents to results: classify, extract, map, repair, triage, substitute OCR text, decide the status.

One projection over the document table. No shuffle: every step is a Column expression of the row, and
CASE branches keep a document from paying for the patterns of other types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import basename, computed_once, strip
from ..operators import fields, mapping, status, types
from ..operators.classify import document_type
from ..sources.pages import first_nonblank

#: Optional document columns and their types; absent ones are taken as null.
OPTIONAL = {
    "tables": "array<array<array<string>>>",
    "read_error": "string",
    "file_hash": "string",
    "file_size_bytes": "bigint",
    "file_mtime": "timestamp_ntz",
    "processing_time": "double",
    "page_ends": "array<int>",
    "ocr_text": "string",
    "ocr_text_length": "bigint",
    "ocr_pages_with_content": "bigint",
    "ocr_page_count": "bigint",
    "ocr_page_ends": "array<int>",
    "ocr_error": "string",
    "ocr_method": "string",
    "ocr_duration_seconds": "double",
}


def raw_data(kind: Column, text: Column, file_name: Column, tables: Column) -> Column:
    """Struct of everything the document's type yields, put together from the registered types."""
    per_type = {name: spec.extracted(text, file_name, tables) for name, spec in types.TYPES.items()}
    members = []
    for field, field_type in S.FIELD_TYPES.items():
        case = F
        for doc_type, found in per_type.items():
            if field in found:
                case = case.when(kind == doc_type, found[field].cast(field_type))
        members.append(case.alias(field))
    return F.struct(*members)


def _with_second_text(docs: DataFrame) -> DataFrame:
    """Types that ask for it take the text of a second reader (`alt_text`) where their own is blank."""
    if "alt_text" not in docs.columns:
        return docs
    asked = F.col("document_type").isin(*(n for n, t in types.TYPES.items() if t.second_text)) & F.col("alt_text").isNotNull()
    blank = F.coalesce(strip(F.col("text")), F.lit("")) == ""
    numbers = {
        "page_ends": F.col("alt_page_ends") if "alt_page_ends" in docs.columns else F.lit(None).cast("array<int>"),
        "text": first_nonblank(F.col("text"), F.col("alt_text")),
    }
    return docs.withColumns({c: F.when(asked & blank, v).otherwise(F.col(c)) for c, v in numbers.items()})


def _extracted(text: Column, tables: Column, config: mapping.MappingConfig) -> Column:
    kind, name = F.col("document_type"), F.col("file_name")
    readable = (kind != S.UNKNOWN) & text.isNotNull()
    return F.when(readable, raw_data(kind, text, name, tables))


def _with_page_key(raw: Column, text: Column, page_ends: Column) -> Column:
    """The key of bid tabs that hold any list is looked for page by page; in all others over the whole text."""
    listed = (F.size(raw["bidders"]) > 0) | (F.size(raw["bid_items"]) > 0)
    by_page = [name for name, spec in types.TYPES.items() if spec.key_by_page]
    paged = F.col("document_type").isin(*by_page) & listed & (F.size(page_ends) > 1)
    key = F.when(paged, fields.key_by_page(text, page_ends)).otherwise(raw["contract_number"])
    return F.when(raw.isNotNull(), raw.withField("contract_number", key))


def with_type(docs: DataFrame) -> DataFrame:
    for name, kind in OPTIONAL.items():
        if name not in docs.columns:
            docs = docs.withColumn(name, F.lit(None).cast(kind))
    return docs.withColumn("file_name", basename(F.col("file_path"))).withColumn(
        "document_type", document_type(F.col("file_path"), F.col("first_page"))
    )


def process_documents(
    docs: DataFrame, run_id: str, config: mapping.MappingConfig | None = None
) -> DataFrame:
    """docs(file_path, first_page, text, text_length, pages_with_content, page_count, ...) to results.

    Where OCR text is joined in (`ocr_text`) and triage asks for it, extraction is repeated on that text
    only for the flagged rows; the original path stays. Triage then judges the statistics of the OCR text
    (`ocr_text_length`, `ocr_pages_with_content`; without them those of one page). Where a second reader's text is joined in (`alt_text`),
    types with a `second_text` read it if their own text is blank; triage still judges the first reader's statistics. A row with `ocr_error` keeps
    its first reading, with `ocr_applied` false and the error in its meta.
    """
    config = config or mapping.MappingConfig()
    kind, name = F.col("document_type"), F.col("file_name")
    typed = _with_second_text(with_type(docs))
    first = computed_once(typed, _raw=_extracted(F.col("text"), F.col("tables"), config))
    first = computed_once(first, _raw=_with_page_key(F.col("_raw"), F.col("text"), F.col("page_ends")))
    first = _assessed(first, config, F.col("text_length"), F.col("pages_with_content"))
    asked = (F.size("needs_ocr_reasons") > 0) & (kind != S.UNKNOWN)
    if "ocr_text" in docs.columns:
        tried = asked & (F.col("ocr_text").isNotNull() | F.col("ocr_error").isNotNull())
        first = computed_once(
            first, ocr_enabled=F.when(asked, F.lit(True)), ocr_attempted=F.when(asked, tried),
            ocr_applied=F.when(tried, F.col("ocr_text").isNotNull() & F.col("ocr_error").isNull()),
        )
        applied = F.coalesce("ocr_applied", F.lit(False))
        reread = _extracted(F.col("ocr_text"), F.col("tables"), config)
        again = computed_once(first, _raw=F.when(applied, reread).otherwise(F.col("_raw")))
        again = computed_once(again, _raw=F.when(
            applied, _with_page_key(F.col("_raw"), F.col("ocr_text"), F.col("ocr_page_ends"))).otherwise(F.col("_raw")))
        shown = strip(F.col("ocr_text")) != ""
        numbers = {
            "text_length": F.coalesce("ocr_text_length", F.when(shown, F.length("ocr_text")).otherwise(0)),
            "pages_with_content": F.coalesce("ocr_pages_with_content", shown.cast("int")),
            "page_count": F.coalesce("ocr_page_count", F.lit(1)),
        }
        again = computed_once(again, **{c: F.when(applied, v).otherwise(F.col(c)) for c, v in numbers.items()})
        first = _assessed(again, config, F.col("text_length"), F.col("pages_with_content"))
    else:
        first = first.withColumns({
            "ocr_enabled": F.when(asked, F.lit(False)), "ocr_attempted": F.when(asked, F.lit(False)),
            "ocr_applied": F.lit(None).cast("boolean"),
        })
    known = kind != S.UNKNOWN
    method = F
    for doc_type, label in S.EXTRACTION_METHOD.items():
        method = method.when(kind == doc_type, F.lit(label))
    return first.select(
        "file_path",
        "file_name",
        "document_type",
        method.alias("extraction_method"),
        status.final_status(
            kind, F.col("data").isNotNull(), F.size("needs_ocr_reasons") > 0, F.col("partial_reasons")
        ).alias("status"),
        F.when(~known, status.NO_EXTRACTOR)
        .when(F.col("data").isNull(), F.coalesce("read_error", F.lit("no readable text")))
        .alias("error"),
        "data",
        F.struct(
            F.when(known, F.lit(run_id)).alias("run_id"),
            F.when(known, F.col("text_length")).cast("bigint").alias("text_length"),
            F.when(known, F.col("pages_with_content")).cast("bigint").alias("text_pages_with_content"),
            F.when(known, F.col("page_count")).cast("bigint").alias("text_page_count"),
            F.when(known, F.size("needs_ocr_reasons") > 0).alias("needs_ocr"),
            F.when(known, F.col("needs_ocr_reasons")).alias("needs_ocr_reasons"),
            F.col("partial_reasons"),
            F.col("contract_number_source"),
            mapping.mapping_meta(kind, config).alias("mapping"),
            F.col("ocr_enabled"),
            F.col("ocr_attempted"),
            F.col("ocr_applied"),
            F.when(F.col("ocr_attempted"), F.col("ocr_error")).alias("ocr_error"),
            F.when(F.col("ocr_attempted"), F.col("ocr_method")).alias("ocr_method"),
            F.when(F.col("ocr_applied"), F.col("ocr_duration_seconds")).alias("ocr_duration_seconds"),
            F.when(known, F.col("file_hash")).alias("file_hash"),
            F.when(known, F.col("file_size_bytes")).alias("file_size_bytes"),
            F.when(known, F.col("file_mtime")).alias("file_mtime"),
            F.when(known, F.col("processing_time")).alias("processing_time"),
        ).alias("meta"),
    )


def _assessed(df: DataFrame, config: mapping.MappingConfig, length: Column, pages: Column) -> DataFrame:
    """From `_raw`: mapped and key-repaired `data` with the reasons for OCR and for being partial."""
    raw, name = F.col("_raw"), F.col("file_name")
    found = F.col("_mapped.contract_number")
    mapped = computed_once(df, _mapped=F.when(raw.isNotNull(), mapping.mapped_data(raw, F.col("document_type"), config)))
    repaired = F.col("_mapped").withField("contract_number", status.repaired_key(found, name))
    whole = computed_once(
        mapped,
        data=F.when(F.col("_mapped").isNotNull(), repaired),
        contract_number_source=F.when(F.col("_mapped").isNotNull(), status.key_source(found, name)),
    )
    has_data = F.col("data").isNotNull()
    return computed_once(
        whole,
        needs_ocr_reasons=status.triage_reasons(status.data_values(F.col("data")), length, pages, has_data),
        partial_reasons=status.partial_reasons(F.col("data.contract_number"), has_data),
    ).drop("_mapped")
