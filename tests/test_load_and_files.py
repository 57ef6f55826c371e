"""Loading, incremental runs, sinks, sources, streams."""

import datetime
import json
from decimal import Decimal

from pyspark.sql import functions as F

from bidloom import schemas as S
from bidloom.operators import incremental as I
from bidloom.operators import load as L
from bidloom.operators import mapping as M
from bidloom.operators import report as R
from bidloom.plans.documents import process_documents
from bidloom.session import materialise
from bidloom.sources import files as FS
from bidloom.sources import pages as P
from bidloom.sources import sinks as K
from bidloom.streaming import ingest as ST

BID = "contract_number string, bidder_name string, total_bid_amount decimal(15,2), seq int"


def test_upsert_last_non_null_wins_and_null_never_erases(spark):
    old = spark.createDataFrame([("A", "old", "x", None, None), ("B", "b", None, None, None)],
                                "contract_number string, wbs_element string, counties string, created_at timestamp, updated_at timestamp")
    new = spark.createDataFrame([("A", None, "c1", 1), ("A", "w2", None, 2), ("A", None, "c3", 3), ("C", None, "n", 1), (None, "lost", "x", 1), ("", "l", "x", 1)],
                                "contract_number string, wbs_element string, counties string, seq int")
    run = F.lit(datetime.datetime(2024, 1, 1))
    got = {r.contract_number: r for r in L.upsert_contracts(old, new, "seq", run).collect()}
    assert set(got) == {"A", "B", "C"}
    assert (got["A"].wbs_element, got["A"].counties) == ("w2", "c3")
    assert (got["B"].wbs_element, got["B"].updated_at) == ("b", None) and got["A"].updated_at is not None
    assert got["C"].wbs_element is None


def test_new_bidders_first_seen_against_table_and_batch(spark):
    old = spark.createDataFrame([("A", "ACME", Decimal("100.00"), 0)], BID)
    new = spark.createDataFrame([("A", " acme ", Decimal("100"), 1), ("A", "ACME", Decimal("200"), 3), ("A", "acme", Decimal("200"), 2), ("B", "ACME", None, 1),
                                 ("B", "ACME", None, 2)], BID)
    got = sorted((r.contract_number, r.bidder_name, r.total_bid_amount, r.seq) for r in L.new_bidders(old, new, "seq").collect())
    assert got == [("A", "acme", Decimal("200.00"), 2), ("B", "ACME", None, 1)]


def test_a_nameless_bidder_rejects_the_batch(spark):
    df = spark.createDataFrame([("A", None, None, 1), ("A", "x", None, 2), ("B", "y", None, 1)], BID)
    assert [r.contract_number for r in L.accepted_batches(df).collect()] == ["B"]


def results(spark):
    line = "RILEY PAVING INC SUPPLY, NC 1,000.00 1\nRILEY PAVING INC SUPPLY, NC 1,000.00 2\n" + "." * 30
    tabs = "DA00001 x\nRILEY PAVING INC SUPPLY, NC\nCONTRACT TOTAL 1,000.00\n\n0001 P1 2 Work EA 3.00 6.00\n" + "." * 30
    rows = [("s/DA00001_Bids As Read.pdf", line, "h1"), ("s/DA00001_Bid Tabs.pdf", tabs, "h2"), ("s/nokey Bids As Read.pdf", line, "h3"),
            ("s/Other.pdf", "x", "h4"), ("s/Award Letter.pdf", None, "h5")]
    df = spark.createDataFrame([(p, t, h, len(t or ""), 1) for p, t, h in rows],
                               "file_path string, text string, file_hash string, text_length bigint, pages_with_content bigint")
    df = df.withColumn("first_page", F.col("text")).withColumn("page_count", F.lit(1))
    return materialise(process_documents(df, "run", M.MappingConfig("/nowhere/source")), "results")


def empty_tables(spark):
    ddl = lambda cols, *more: ", ".join([*(f"{c} {t}" for c, t in cols.items()), *more])
    child = "contract_number string, source_file_path string, source_file_hash string, position int"
    return {
        "contracts": spark.createDataFrame([], ddl(S.CONTRACT_COLUMNS)),
        "bidders": spark.createDataFrame([], child + ", " + ddl(S.BIDDER_COLUMNS)),
        "bid_items": spark.createDataFrame([], child + ", " + ddl(S.ITEM_COLUMNS)),
        "extraction_logs": spark.createDataFrame([], ddl(S.LOG_COLUMNS)),
    }


def test_loading_twice_equals_loading_once(spark, tmp_path):
    done = results(spark)
    once = L.load_tables(done, empty_tables(spark))
    K.save_tables(once, str(tmp_path / "v1"))
    stored = {n: spark.read.parquet(str(tmp_path / "v1" / n)) for n in once}
    twice = L.load_tables(done, stored)
    for name in ("contracts", "bidders", "bid_items"):
        key = [c for c in stored[name].columns]
        assert sorted(map(str, twice[name].select(key).collect())) == sorted(map(str, stored[name].collect())), name
    assert [r.contract_number for r in stored["contracts"].collect()] == ["DA00001"]
    assert stored["bidders"].count() == 1, "one name and amount per contract, whichever file it came from"
    assert stored["bid_items"].first().unit == "Ea"
    assert twice["extraction_logs"].count() == 10
    assert L.children_with_id(stored["bidders"], stored["contracts"]).first().contract_id is not None
    summary = L.load_summary(done).first()
    assert (summary.total, summary.successful, summary.failed, summary.success_rate) == (5, 4, 1, "80.0%")


def test_incremental_runs(spark):
    files = spark.createDataFrame([("a Bid Tabs.pdf", "h", 1, 1), ("b", "h", 1, 1), ("c", "h2", 1, 1), ("d", "h", 1, 2), ("e", "h", 1, 1)],
                                  "file_path string, file_hash string, file_size_bytes bigint, file_mtime int")
    state = spark.createDataFrame([("a Bid Tabs.pdf", "h", 1, 1), ("c", "h", 1, 1), ("d", "h", 1, 1), ("z", "h", 1, 1)], files.schema)
    assert sorted(r.file_path for r in I.changed(files, state).collect()) == ["b", "c", "d", "e"], "a new time alone is a change"
    skipped = I.skip_rows(files, state, "run").collect()
    assert [(r.file_path, r.document_type, r.status, r.error, r.run_id) for r in skipped] == [("a Bid Tabs.pdf", S.BID_TABS, "skipped", "unchanged", "run")]
    done = files.withColumn("status", F.when(F.col("file_path") == "c", "success").otherwise("partial"))
    merged = I.merge_state(state, done)
    assert {r.file_path: r.file_hash for r in merged.collect()} == {"a Bid Tabs.pdf": "h", "c": "h2", "d": "h", "z": "h"}
    again = I.merge_state(merged, done)
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_state_snapshots(spark, tmp_path):
    assert I.read_state(spark, str(tmp_path / "none")).count() == 0
    state = spark.createDataFrame([("a", "h", 1, None)], I.STATE_SCHEMA)
    path = I.write_state(state, str(tmp_path), 3)
    assert path.endswith("state-3") and I.read_state(spark, path).first().file_hash == "h"


def test_scan_fingerprint_and_listing(spark, tmp_path):
    import hashlib

    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.pdf").write_bytes(b"abc")
    (tmp_path / "b.PDF").write_bytes(b"")
    found = FS.scan_files(spark, str(tmp_path))
    row = FS.fingerprint(found).first()
    assert found.count() == 1 and row.file_hash == hashlib.sha256(b"abc").hexdigest() and row.file_size_bytes == 3
    assert row.file_mtime_iso.endswith("+00:00")
    refused = FS.scan_files(spark, str(tmp_path), max_bytes=1)
    assert refused.count() == found.count() and refused.where("content is not null or read_error is null").count() == 0
    assert FS.fingerprint(refused).where("file_hash is null and read_error like 'file of % bytes; at most 1 are read'").count() == found.count()
    keys = spark.createDataFrame([("raw/one.pdf",), ("raw/two.txt",), ("raw/three.PDF",), ("old/x.pdf",)], "key string")
    assert sorted(r.key for r in FS.list_keys(keys, "raw/", max_items=2).collect()) == ["raw/one.pdf", "raw/three.PDF"]
    assert FS.list_keys(keys, "raw/", max_items=0).count() == 2
    local = FS.key_map(spark.createDataFrame([("raw/1/a.pdf",), ("raw/2/a.pdf",)], "key string"), "/tmp/in/")
    assert [(r.file_path, r.key) for r in local.collect()] == [("/tmp/in/a.pdf", "raw/2/a.pdf")]


def test_routing(spark):
    res = spark.createDataFrame([("/l/a.pdf", "failed"), ("/l/b.pdf", "partial"), ("/l/c.pdf", "skipped"), ("/l/d.pdf", "success")], "file_path string, status string")
    keys = spark.createDataFrame([("/l/a.pdf", "raw/a.pdf"), ("/l/b.pdf", "raw/b.pdf"), ("/l/c.pdf", "raw/x/c.pdf")], "file_path string, key string")
    plan = {r.src_key: r.new_key for r in K.route_sources(res, keys, "processed/", "error/").collect()}
    assert plan == {"raw/a.pdf": "error/a.pdf", "raw/b.pdf": "processed/b.pdf", "raw/x/c.pdf": "error/c.pdf"}


def test_result_files_and_reports(spark, tmp_path):
    done = results(spark)
    flat = K.write_results(done, str(tmp_path) + "/", "r1", "PARQUET")
    assert flat.endswith("results/results_r1.parquet")
    back = spark.read.parquet(flat)
    assert {"data.contract_number", "meta.mapping.mapping_name", "data.bidders"} <= set(back.columns) and back.count() == 5
    lines = K.write_results(done, str(tmp_path), "r1", "csv")
    assert lines.endswith(".jsonl") and spark.read.text(lines).count() == 5
    report = K.report_rows(R.run_summary(done), done)
    K.write_report(report, str(tmp_path / "report"))
    stored = spark.read.text(str(tmp_path / "report"))
    assert stored.where("section = 'results'").count() == 5
    summary = json.loads(stored.where("section = 'summary'").first().value)
    assert summary["total_files"] == 5 and summary["partial"] == 1
    assert K.report_rows(R.run_summary(done), done, summary_only=True).count() == 1
    items = R.items_report(done)
    K.write_items_report(items, str(tmp_path / "items"))
    assert spark.read.option("header", True).csv(str(tmp_path / "items")).first().bid_items_count == "1"
    sample = R.sample_results(done).collect()
    assert len(sample) == 3 and sample[0].file_path == "s/Award Letter.pdf"
    assert "contract_number: DA00001" in [r.fields for r in sample if "Bid Tabs" in r.file_path][0]


PAGES = "doc_id string, page_no int, text string"


def test_pages(spark):
    df = spark.createDataFrame([("a", 1, "Some text"), ("a", 0, ""), ("b", 0, " x\n"), ("a", 2, None)], PAGES).repartition(4)
    assert {r.doc_id: r.text for r in P.assemble_text(df).collect()} == {"a": "\nSome text\n\n", "b": " x\n\n"}
    many = spark.range(5000).select(F.lit("c").alias("doc_id"), F.col("id").cast("int").alias("page_no"), F.concat(F.lit("p"), F.col("id")).alias("text"))
    assert [r.text for r in P.assemble_text(many).collect()] == ["\n".join(f"p{i}" for i in range(5000)) + "\n"]
    assert P.documents(many.withColumnRenamed("doc_id", "file_path")).count() == 1
    stats = {r.doc_id: tuple(r)[1:] for r in P.text_stats(df).collect()}
    assert stats == {"a": (9, 1, 3), "b": (3, 1, 1)}
    one = {r.doc_id: (r.text, r.error) for r in P.page_text(df, 1).collect()}
    assert one == {"a": ("Some text", None), "b": (None, "Page 1 does not exist")}
    row = spark.range(1).select(P.first_nonblank(F.lit(" \n"), F.lit(None), F.lit("c")).alias("a"), P.first_nonblank(F.lit(""), F.lit(" ")).alias("b")).first()
    assert (row.a, row.b) == ("c", " ")
    docs = P.documents(df.withColumnRenamed("doc_id", "file_path")).where("file_path = 'a'").first()
    assert (docs.first_page, docs.text, docs.text_length, docs.pages_with_content, docs.page_count) == ("", "\nSome text\n\n", 9, 1, 3)


def test_streams(spark, tmp_path):
    log = "file_path string, ts timestamp, document_type string, status string, processing_time double"
    day = lambda d, h: datetime.datetime(2024, 1, d, h)
    land = str(tmp_path / "land")
    rows = [("a", day(1, 1), "t", "success", 1.0), ("b", day(1, 2), "t", "failed", 2.0), ("c", day(2, 1), "t", "success", 3.0)]
    spark.createDataFrame(rows, log).coalesce(1).write.parquet(land)
    spark.createDataFrame(rows[:1] + [("d", day(3, 5), "t", "success", 4.0)], log).coalesce(1).write.mode("append").parquet(land)
    stream = lambda: ST.landing_stream(spark, land, log, max_files=1)
    counts = ST.collect_batches(stream(), lambda df: df.groupBy("status").agg(F.count(F.lit(1)).alias("n")), "counts")
    assert counts.count() > 2, "one partial count per batch"
    assert {r.status: r.n for r in ST.counts_from_batches(counts, ["status"]).collect()} == {"success": 4, "failed": 1}
    once = ST.append_to_table(ST.drop_redelivered(stream(), ["file_path"], "ts", "10 days"), "once")
    assert sorted(r.file_path for r in once.collect()) == ["a", "b", "c", "d"]
    closed = ST.append_to_table(ST.status_by_window(stream(), "ts", "1 day", "1 hour"), "closed").collect()
    assert {r.window_start.day for r in closed} == {1, 2} and sum(r.failed for r in closed) == 1
