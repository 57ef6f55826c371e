"""Page tables to document texts and text statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITESPACE, running_fold


def _blank(text: Column) -> Column:
    return F.coalesce(F.btrim(text, F.lit(WHITESPACE)), F.lit("")) == ""


def assemble_text(pages: DataFrame) -> DataFrame:
    """pages(doc_id, page_no, text) to (doc_id, text): pages in order, a line break after each, one row a document."""
    ordered = F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))))
    return pages.groupBy("doc_id").agg(
        F.concat(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n"), F.lit("\n")).alias("text")
    )


def page_text(pages: DataFrame, number: int) -> DataFrame:
    """Text of one page per document; a document that is shorter gets an error instead."""
    wanted = F.col("page_no") == number
    found = pages.groupBy("doc_id").agg(
        F.max(F.when(wanted, F.col("text"))).alias("text"), F.bool_or(wanted).alias("_found")
    )
    return found.select("doc_id", "text", F.when(~F.col("_found"), f"Page {number} does not exist").alias("error"))


def first_nonblank(*candidates: Column) -> Column:
    """First candidate with visible text, else the last one (null as empty)."""
    last = F.coalesce(candidates[-1], F.lit(""))
    return reduce(lambda rest, c: F.when(~_blank(c), c).otherwise(rest), reversed(candidates[:-1]), last)


def text_stats(pages: DataFrame) -> DataFrame:
    """Characters on pages with visible text (whole pages, not trimmed), number of such pages, of all pages."""
    shown = ~_blank(F.col("text"))
    return pages.groupBy("doc_id").agg(
        F.coalesce(F.sum(F.when(shown, F.length("text").cast("bigint"))), F.lit(0)).alias("text_length"),
        F.count_if(shown).alias("text_pages_with_content"),
        F.count(F.lit(1)).alias("text_page_count"),
    )


def documents(pages: DataFrame, keys: Sequence[str] = ("file_path",)) -> DataFrame:
    """Document table for `process_documents`: text, first page and statistics from one shuffle, a row for each value of `keys`.

    `page_ends` counts, for every page, the characters of the text up to and with that page's line break.
    """
    shown = ~_blank(F.col("text"))
    page = F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))
    grouped = pages.groupBy(*keys).agg(
        F.array_sort(F.collect_list(page)).alias("_pages"),
        F.coalesce(F.sum(F.when(shown, F.length("text").cast("bigint"))), F.lit(0)).alias("text_length"),
        F.count_if(shown).alias("pages_with_content"),
        F.count(F.lit(1)).alias("page_count"),
    )
    return grouped.select(
        *keys,
        F.when(F.col("_pages")[0]["page_no"] == 0, F.col("_pages")[0]["text"]).alias("first_page"),
        F.concat(F.array_join(F.transform("_pages", lambda p: p["text"]), "\n"), F.lit("\n")).alias("text"),
        "text_length", "pages_with_content", "page_count",
        running_fold(
            F.transform("_pages", lambda p: F.length(p["text"])), F.lit(0), lambda at, n: (at + n + 1, at + n + 1), "int"
        ).alias("page_ends"),
    )
