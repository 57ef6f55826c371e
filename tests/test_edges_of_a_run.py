"""What a run does at its edges: OCR outcomes, keys by page, values that do not fit, audit columns, repeated landings."""

import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from bidloom import schemas as S
from bidloom.operators import fields as X
from bidloom.operators import load as L
from bidloom.operators.mapping import MappingConfig
from bidloom.plans import run
from bidloom.session import materialise
from bidloom.streaming import ingest as ST
from tests.test_load_and_files import empty_tables
from tests.test_run import FILES, PAGES, T

CONFIG = MappingConfig("/nowhere/source")


def batch(spark, pages, ocr=None):
    names = sorted({p[0] for p in pages})
    files = spark.createDataFrame([(n, "h", 1, T) for n in names], FILES)
    scans = None if ocr is None else spark.createDataFrame(ocr, PAGES + ", ocr_method string, ocr_duration_seconds double, ocr_error string")
    done = run.extract_batch(files, spark.createDataFrame(pages, PAGES), "r", None, scans, CONFIG)
    return {r.file_path: r for r in done.collect()}


def test_ocr_outcomes(spark):
    award = "NOTIFICATION OF AWARD May 1, 2024\nContract No. DA0000{} in the amount of $ 5.00"
    names = ["1 Award Letter.pdf", "2 Award Letter.pdf", "3 Award Letter.pdf", "4 Award Letter.pdf", "5 Award Letter.pdf"]
    ocr = [(names[0], 0, award.format(1), "scan", 2.0, None), (names[0], 1, " ", "scan", 2.0, None),
           (names[1], 0, " " * 80, "scan", 1.0, None), (names[2], 0, None, "scan", None, "timeout"),
           (names[3], 0, "Contract No. DA00004 in the amount of $ 5.00 xxxx", "scan", 1.0, None)]
    got = batch(spark, [(n, 0, " ") for n in names], ocr)
    first, blank, failed, short, none = (got[n] for n in names)
    assert (first.status, first.meta.text_length, first.meta.text_pages_with_content, first.meta.text_page_count) == ("success", len(award) - 1, 1, 2)
    assert (blank.status, blank.meta.text_length, blank.meta.ocr_applied) == ("partial", 0, True)
    assert blank.meta.needs_ocr_reasons == ["no_text_extracted", "empty_data"]
    assert (failed.meta.ocr_attempted, failed.meta.ocr_applied, failed.meta.ocr_error, failed.meta.ocr_method) == (True, False, "timeout", "scan")
    assert short.meta.text_length == 49 and "no_text_extracted" in short.meta.needs_ocr_reasons and short.data.contract_number == "DA00004"
    assert (none.meta.ocr_enabled, none.meta.ocr_attempted, none.meta.ocr_applied) == (True, False, None)
    off = batch(spark, [(names[0], 0, " ")])[names[0]]
    assert (off.meta.ocr_enabled, off.meta.ocr_attempted, off.meta.ocr_applied) == (False, False, None)


def test_bid_tabs_take_the_key_of_the_first_page_that_has_one(spark):
    bids = "RILEY PAVING INC SUPPLY, NC\nTOTAL 5.00\n" + "." * 40
    pages = [("a Bid Tabs.pdf", 0, "sheet 12089199"), ("a Bid Tabs.pdf", 1, "DA00777\n" + bids),
             ("b Bid Tabs.pdf", 0, "none"), ("b Bid Tabs.pdf", 1, "12089199 DA00777\n" + bids),
             ("c Bid Tabs.pdf", 0, "12089199"), ("c Bid Tabs.pdf", 1, "DA00777 " + "." * 60),
             ("d Bid Tabs.pdf", 0, "DA00777"), ("d Bid Tabs.pdf", 1, "12089199\n" + bids)]
    got = {p[0]: r.data.contract_number for p, r in batch(spark, pages).items()}
    assert got == {"a": "12089199", "b": "DA00777", "c": "DA00777", "d": "DA00777"}, "c has no lists: the whole text counts"
    row = spark.createDataFrame([("12089199\nDA00777\n", [9, 17]), ("x", [2]), ("\U0001F600 12089199\nDA00777\n", [11, 19])], "t string, e array<int>")
    assert [r.k for r in row.select(X.key_by_page(F.col("t"), F.col("e")).alias("k")).collect()] == ["12089199", None, "12089199"]


def test_values_that_do_not_fit_are_refused_and_counted(spark):
    line = "Bids read aloud\nACME PAVING INC DURHAM, NC {}.00\n" + "." * 40
    award = "NOTIFICATION OF AWARD May 1, 2024\nContract No. DA0000{} in the amount of $ {}.00 " + "." * 20
    pages = [("DA00001_Bids As Read.pdf", 0, line.format("1,000")), ("DA00002_Bids As Read.pdf", 0, line.format("99,999,999,999,999")),
             ("3 Award Letter.pdf", 0, award.format(3, "99,999,999,999,999")), ("4 Award Letter.pdf", 0, award.format(4, 7))]
    files = spark.createDataFrame([(p[0], "h", 1, T) for p in pages], FILES)
    done = materialise(run.extract_batch(files, spark.createDataFrame(pages, PAGES), "r", None, None, CONFIG), "fit")
    tables = L.load_tables(done, empty_tables(spark))
    assert sorted(r.contract_number for r in tables["contracts"].collect()) == ["DA00001", "DA00002", "DA00004"]
    assert [r.contract_number for r in tables["bidders"].collect()] == ["DA00001"]
    assert {r.file_path: (r.table_name, r.columns) for r in L.rejected_rows(done).collect()} == {
        "DA00002_Bids As Read.pdf": ("bidders", ["total_bid_amount"]), "3 Award Letter.pdf": ("contracts", ["awarded_amount"])}
    assert tuple(L.load_summary(done).first()) == (4, 3, 1, "75.0%")


def test_audit_columns_and_new_columns_stay(spark):
    day = datetime.datetime(2024, 1, 1)
    old = spark.createDataFrame([("A", "w", day, day), ("B", "w", day, day)], "contract_number string, wbs_element string, created_at timestamp, updated_at timestamp")
    new = spark.createDataFrame([("A", None, Decimal("1.00"), 1), ("C", "n", None, 2)], "contract_number string, wbs_element string, estimated_cost decimal(15,2), seq int")
    kept = {r.contract_number: r for r in L.upsert_contracts(old, new, "seq").collect()}
    assert (kept["A"].created_at, kept["A"].updated_at, kept["A"].estimated_cost, kept["C"].created_at) == (day, day, Decimal("1.00"), None)
    later = datetime.datetime(2025, 1, 1)
    stamped = {r.contract_number: (r.created_at, r.updated_at) for r in L.upsert_contracts(old, new, "seq", F.lit(later)).collect()}
    assert stamped == {"A": (day, later), "B": (day, day), "C": (later, later)}
    plain = L.upsert_contracts(old.drop("created_at", "updated_at"), new, "seq", F.lit(later)).where("contract_number = 'C'").first()
    assert (plain.created_at, plain.updated_at) == (later, later)


def test_a_second_landing_run_takes_only_new_files(spark, tmp_path):
    land, home = str(tmp_path / "land"), str(tmp_path / "home")
    put = lambda name: spark.createDataFrame([(name, 0, "Bids read\nACME PAVING INC DURHAM, NC 1.00\n" + "." * 40)], PAGES).coalesce(1).write.mode("append").parquet(land)
    spark.createDataFrame([], PAGES).write.mode("ignore").parquet(land)
    ingest = lambda run_id: run.ingest_landing(ST.landing_stream(spark, land, PAGES, max_files=1), run_id, CONFIG, home)
    put("DA00001_Bids As Read.pdf")
    assert [r.meta.run_id for r in ingest("r1").collect()] == ["r1"]
    put("DA00002_Bids As Read.pdf")
    assert {r.data.contract_number: r.meta.run_id for r in ingest("r2").collect()} == {"DA00001": "r1", "DA00002": "r2"}
    assert ingest("r3").count() == 2


def test_streams_over_an_empty_folder_and_unordered_files(spark, tmp_path):
    log = "file_path string, ts timestamp, document_type string, status string, processing_time double"
    empty = str(tmp_path / "empty")
    (tmp_path / "empty").mkdir()
    assert ST.first_deliveries(ST.landing_stream(spark, empty, log), lambda df: df, ["file_path"], ["ts"], "none").count() == 0
    land = str(tmp_path / "land")
    for name, day in (("a", 9), ("e", 1), ("a", 3), ("g", 2)):
        spark.createDataFrame([(name, datetime.datetime(2024, 1, day), "t", "success", 1.0)], log).coalesce(1).write.mode("append").parquet(land)
    stream = lambda: ST.landing_stream(spark, land, log, max_files=1)
    assert sorted(r.file_path for r in ST.first_deliveries(stream(), lambda df: df, ["file_path"], ["ts"], "once").collect()) == ["a", "e", "g"]
    counts = ST.counts_from_batches(
        ST.collect_batches(stream(), lambda df: ST.window_counts(df, "ts", "1 day"), "open"), ["window_start", "document_type"])
    assert {r.window_start.day: r.results for r in counts.collect()} == {1: 1, 2: 1, 3: 1, 9: 1}


def test_of_unequal_deliveries_the_first_by_time_stays_in_any_order_of_files(spark, tmp_path):
    log = "file_path string, ts timestamp, source string, n int"
    day = lambda d: datetime.datetime(2024, 1, d)
    files = [[("a", day(3), "f1", 1), ("b", day(1), "f1", 1)], [("a", day(2), "f2", 2), ("b", day(1), "f0", 2)], [("a", day(2), "f2", 1), ("c", day(9), "f3", None)]]
    for number, order in enumerate(((0, 1, 2), (2, 1, 0))):
        land, home = str(tmp_path / f"land{number}"), str(tmp_path / f"home{number}")
        for k in order:  # a run after each file
            spark.createDataFrame(files[k], log).coalesce(1).write.mode("append").parquet(land)
            table = ST.first_deliveries(ST.landing_stream(spark, land, log), lambda df: df, ["file_path"], ["ts", "source"], "first", home)
        assert sorted((r.file_path, r.ts.day, r.source, r.n) for r in table.collect()) == [("a", 2, "f2", 1), ("b", 1, "f0", 2), ("c", 9, "f3", None)]
        assert [spark.read.parquet(f"{home}/out/batch={b}").count() for b in range(3)] == [2, 2, 2], "a run writes the keys of its own rows"
