"""A whole run, then a second one over changed files; and the landing-folder form."""

import datetime
import json

from bidloom import schemas as S
from bidloom.operators import incremental as I
from bidloom.operators.mapping import MappingConfig
from bidloom.plans import run
from bidloom.streaming.ingest import landing_stream
from tests.test_load_and_files import empty_tables

FILES = "file_path string, file_hash string, file_size_bytes bigint, file_mtime timestamp_ntz"
PAGES = "file_path string, page_no int, text string"
T = datetime.datetime(2024, 1, 1)
CONFIG = MappingConfig("/nowhere/source")


def pages(spark):
    line = "RILEY PAVING INC SUPPLY, NC {},000.00"
    return spark.createDataFrame([
        ("in/DA00001_Bids As Read.pdf", 0, "Bids read aloud on Tuesday\n" + line.format(1)), ("in/DA00001_Bids As Read.pdf", 1, line.format(2)),
        ("in/DA00002_Bid Summary.pdf", 0, "Summary sheet\n1 " + line.format(3) + " 0.5%\n" + "." * 30),
        ("in/Award Letter.pdf", 0, " "),
    ], PAGES)


def files(spark, changed="h"):
    names = ["in/DA00001_Bids As Read.pdf", "in/DA00002_Bid Summary.pdf", "in/Award Letter.pdf", "in/DA00009_Bid Tabs.pdf"]
    return spark.createDataFrame([(n, changed if "Summary" in n else "h", 1, T) for n in names], FILES)


def test_two_runs(spark, tmp_path):
    ocr = spark.createDataFrame(
        [("in/Award Letter.pdf", 0, "NOTIFICATION OF AWARD May 1, 2024\nContract No. DA00003 in the amount of $ 5.00 ....", "scan", 2.0)],
        PAGES + ", ocr_method string, ocr_duration_seconds double")
    none = I.read_state(spark, str(tmp_path / "none"))
    first = run.extract_batch(files(spark), pages(spark), "r1", none, ocr, CONFIG)
    got = {r.file_path: r for r in first.collect()}
    assert {p.split("/")[1]: r.status for p, r in got.items()} == {
        "DA00001_Bids As Read.pdf": "success", "DA00002_Bid Summary.pdf": "success", "Award Letter.pdf": "success", "DA00009_Bid Tabs.pdf": "failed"}
    assert [b.bid_rank for b in got["in/DA00001_Bids As Read.pdf"].data.bidders] == [1, 2]
    assert got["in/Award Letter.pdf"].meta.ocr_duration_seconds == 2.0
    assert got["in/DA00001_Bids As Read.pdf"].meta.text_page_count == 2

    paths = run.finish_batch(first, str(tmp_path / "out"), "r1", empty_tables(spark), state=none)
    tables = {n: spark.read.parquet(f"{paths['tables']}/{n}") for n in empty_tables(spark)}
    assert sorted(r.contract_number for r in tables["contracts"].collect()) == ["DA00001", "DA00002", "DA00003"]
    assert tables["bidders"].count() == 3 and tables["extraction_logs"].count() == 4
    assert json.loads(spark.read.text(paths["report"]).where("section = 'summary'").first().value)["success_rate"] == "75.0%"

    state = I.read_state(spark, paths["state"])
    assert state.count() == 3, "failed files are not remembered"
    second = run.extract_batch(files(spark, "h2"), pages(spark), "r2", state, ocr, CONFIG)
    again = {r.file_path.split("/")[1]: (r.status, r.error, r.document_type, r.meta.run_id) for r in second.collect()}
    assert again["DA00001_Bids As Read.pdf"] == ("skipped", "unchanged", S.AS_READ, "r2")
    assert again["DA00002_Bid Summary.pdf"][0] == "success" and again["DA00009_Bid Tabs.pdf"][0] == "failed"
    after = run.finish_batch(second, str(tmp_path / "out"), "r2", tables, "jsonl", state)
    assert spark.read.parquet(f"{after['tables']}/bidders").count() == 3, "nothing is loaded twice"
    assert {r.file_path: r.file_hash for r in I.read_state(spark, after["state"]).collect()}["in/DA00002_Bid Summary.pdf"] == "h2"


def test_landing_folder(spark, tmp_path):
    land = str(tmp_path / "land")
    for name in ("DA00001_Bids As Read", "DA00002_Bid Summary"):
        pages(spark).where(f"file_path like '%{name}%'").coalesce(1).write.mode("append").parquet(land)
    done = run.ingest_landing(landing_stream(spark, land, PAGES, max_files=1), "r1", CONFIG)
    assert {r.document_type: r.status for r in done.collect()} == {S.AS_READ: "success", S.SUMMARY: "success"}
