"""Pages of one document that arrive in several files: keyed streaming state holds them until the document is whole."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, islice
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: What a page row needs. `file_version` tells deliveries of a changed file apart (its hash or time); `page_count` may be on any row.
PAGE_SCHEMA = "file_path string, file_version string, page_no int, text string, page_count int"
GATHERED = "file_path string, file_version string, page_no int, text string, page_error string"
#: Pages that go out in one piece; a document of any length leaves in pieces of this size.
PAGES_AT_ONCE = 256


def _marked(numbers: bytes, page_no: int) -> bool:
    return page_no >> 3 < len(numbers) and bool(numbers[page_no >> 3] >> (page_no & 7) & 1)


class WholeDocuments(StatefulProcessor):
    """One document is one key (file_path, file_version).

    Its pages wait in a list, their numbers in a bit set, so a page that comes again is ignored. When as many pages wait as the
    document has, they leave together and only a mark stays, by which later repeats are ignored. A document that is not whole when its
    time is up leaves as one row with an error. A call costs a fixed number of state operations and what its own rows need."""

    def __init__(self, hold_ms: int | None):
        self.hold_ms = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getListState("pages", "page_no int, text string")
        self.known = handle.getValueState("known", "page_count int, waiting int, numbers binary, closed boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        known = self.known.get()
        count, waiting, numbers, closed = known if known is not None else (None, 0, b"", False)
        if closed:
            return
        fresh: dict[int, str] = {}
        for batch in rows:
            for page_no, text, stated in zip(batch["page_no"], batch["text"], batch["page_count"]):
                if not pd.isna(stated):
                    count = max(int(stated), count or 0)
                if not pd.isna(page_no) and not _marked(numbers, int(page_no)):
                    text = "" if text is None or pd.isna(text) else text
                    fresh[int(page_no)] = min(text, fresh.get(int(page_no), text))
        if count is not None and waiting + len(fresh) >= count:
            held = chain(self.pages.get() if waiting else (), fresh.items())
            yield from self._pieces(key, held)
            self._close(count, waiting)
            return
        if fresh:
            self.pages.appendList(list(fresh.items()))
            marks = bytearray(numbers) + bytes(max(0, (max(fresh) >> 3) + 1 - len(numbers)))
            for page_no in fresh:
                marks[page_no >> 3] |= 1 << (page_no & 7)
            numbers = bytes(marks)
        self.known.update((count, waiting + len(fresh), numbers, False))
        if self.hold_ms is not None and known is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.hold_ms)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        known = self.known.get()
        if known is None or known[3]:
            return
        yield self._broken(key, f"{known[1]} of {'an unknown number of' if known[0] is None else known[0]} pages arrived")
        self._close(known[0], known[1])

    def _pieces(self, key: Any, held: Iterator[tuple[int, str]]) -> Iterator[pd.DataFrame]:
        some = list(islice(held, PAGES_AT_ONCE))
        if not some:
            yield self._broken(key, "no pages")
        while some:
            n = len(some)
            yield pd.DataFrame({
                "file_path": [key[0]] * n, "file_version": [key[1]] * n, "page_no": [p for p, _ in some], "text": [t for _, t in some],
                "page_error": [None] * n})
            some = list(islice(held, PAGES_AT_ONCE))

    @staticmethod
    def _broken(key: Any, error: str) -> pd.DataFrame:
        return pd.DataFrame({"file_path": [key[0]], "file_version": [key[1]], "page_no": [None], "text": [None], "page_error": [error]})

    def _close(self, count: int | None, waiting: int) -> None:
        if waiting:
            self.pages.clear()
        self.known.update((count, 0, b"", True))

    def close(self) -> None:
        pass


def page_columns(pages: DataFrame) -> DataFrame:
    """The columns of PAGE_SCHEMA; a missing version or count is null (one version, count unknown)."""
    given = set(pages.columns)
    return pages.where("file_path is not null and coalesce(page_no, 0) >= 0").select(
        "file_path", F.coalesce(F.col("file_version").cast("string"), F.lit("")).alias("file_version") if "file_version" in given
        else F.lit("").alias("file_version"),
        F.col("page_no").cast("int").alias("page_no"), F.col("text").cast("string").alias("text"),
        (F.col("page_count") if "page_count" in given else F.lit(None)).cast("int").alias("page_count"))


def whole_documents(page_stream: DataFrame, hold: str | None = "1 day") -> DataFrame:
    """Stream of (file_path, file_version, page_no, text, page_error): the pages of documents that have become whole.

    All pages of a document come out in one micro-batch, whichever files and micro-batches they arrived in and in whatever order. A
    document is whole when as many distinct pages have arrived as the largest `page_count` on any of its rows says; a row without page
    number only states the count; negative page numbers are left out. A document that is not whole `hold` after its first row (None: never) comes out as one row with
    `page_error` and no page, and is closed as well. Rows of a closed document are ignored.

    State is keyed by document and lives in RocksDB (`ingest.use_rocksdb`), so a run costs what its own rows cost, not what is held.
    """
    hold_ms = None if hold is None else int(pd.Timedelta(hold).total_seconds() * 1000)
    return (
        page_columns(page_stream).groupBy("file_path", "file_version")
        .transformWithStateInPandas(
            statefulProcessor=WholeDocuments(hold_ms), outputStructType=GATHERED, outputMode="Append",
            timeMode="None" if hold is None else "ProcessingTime"))
