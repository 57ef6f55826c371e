"""Key repair, completeness, OCR triage and the status machine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.parse import falsy
from ..functions.text import WHITESPACE
from .fields import key_from_name

# Fixed values
MIN_TEXT_LENGTH = 50
NO_EXTRACTOR = "No extractor available for this document type"
UNCHANGED = "unchanged"


def repaired_key(key: Column, file_name: Column) -> Column:
    """A missing key is taken from the file name."""
    return F.when(falsy(key, "text"), F.coalesce(key_from_name(file_name), key)).otherwise(key)


def key_source(key: Column, file_name: Column) -> Column:
    return F.when(falsy(key, "text") & key_from_name(file_name).isNotNull(), F.lit("filename"))


def _count(flags: Sequence[Column]) -> Column:
    return sum((F.when(f, 1).otherwise(0) for f in flags), F.lit(0))


def _present(values: dict[str, Column]) -> list[Column]:
    """Filled for completeness: not null and not the empty string; an empty list counts as filled."""
    return [
        v.isNotNull() & (v != "") if S.FIELD_TYPES.get(f) == "string" else v.isNotNull() for f, v in values.items()
    ]


def _telling(values: dict[str, Column]) -> list[Column]:
    """Filled for triage: blank strings and empty lists do not count."""
    flags = []
    for field, v in values.items():
        kind = S.FIELD_TYPES.get(field, "string")
        if kind.startswith("array"):
            flags.append(v.isNotNull() & (F.size(v) > 0))
        elif kind == "string":
            flags.append(v.isNotNull() & (F.btrim(v, F.lit(WHITESPACE)) != ""))
        else:
            flags.append(v.isNotNull())
    return flags


def data_values(data: Column) -> dict[str, Column]:
    return {f: data[f] for f in S.FIELD_TYPES}


def expected_count(kind: Column) -> Column:
    case = F
    for doc_type, fields in S.EXPECTED_FIELDS.items():
        case = case.when(kind == doc_type, F.lit(len(fields)))
    return case


def completeness(values: dict[str, Column], expected: Column) -> Column:
    """Share of the expected fields that are filled, 0 when nothing is expected."""
    return F.coalesce(F.try_divide(_count(_present(values)), expected), F.lit(0.0))


def triage_reasons(
    values: dict[str, Column], text_length: Column, pages_with_content: Column, has_data: Column | None = None
) -> Column:
    """Why a document should go through OCR, as an array of reasons."""
    length, pages = F.coalesce(text_length, F.lit(0)), F.coalesce(pages_with_content, F.lit(0))
    filled = _count(_telling(values))
    if has_data is not None:
        filled = F.when(has_data, filled).otherwise(0)
    no_lists = F.lit(False)
    if "bidders" in values and "bid_items" in values:
        no_lists = F.coalesce((F.size(values["bidders"]) == 0) & (F.size(values["bid_items"]) == 0), F.lit(False))
    return F.array_compact(F.array(
        F.when((pages == 0) | (length < MIN_TEXT_LENGTH), F.lit("no_text_extracted")),
        F.when(filled == 0, F.lit("empty_data")).when((filled <= 1) & no_lists, F.lit("low_field_coverage")),
    ))


def partial_reasons(key: Column, has_data: Column) -> Column:
    return F.array_compact(F.array(F.when(has_data & falsy(key, "text"), F.lit("missing_contract_number"))))


def final_status(
    kind: Column, extracted: Column, needs_ocr: Column, reasons: Column, unchanged: Column | None = None
) -> Column:
    """`extracted` says whether extraction succeeded; a document that needs OCR or lacks its key is partial."""
    status = (
        F.when(kind == S.UNKNOWN, "skipped")
        .when(~extracted, "failed")
        .when(needs_ocr | (F.size(reasons) > 0), "partial")
        .otherwise("success")
    )
    return status if unchanged is None else F.when(unchanged, "skipped").otherwise(status)
