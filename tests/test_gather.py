"""Documents whose pages arrive in several files."""

import itertools

from bidloom.operators.mapping import MappingConfig
from bidloom.plans import run
from bidloom.sources.pages import documents
from bidloom.streaming.gather import whole_documents
from bidloom.streaming.ingest import collect_batches, landing_stream, use_rocksdb

CONFIG = MappingConfig("/nowhere/source")
SPLIT = "file_path string, file_version string, page_no int, text string, page_count int"
LINE = "ACME PAVING {} INC DURHAM, NC {},000.00\n"


def paged(name, n, version="v1"):
    return [(name, version, k, ("Bids read aloud\n" if k == 0 else "") + LINE.format("ABCDEFGHIJ"[k], k + 1) + "." * 40, n) for k in range(n)]


def land(spark, folder, rows):
    spark.createDataFrame(rows, SPLIT).coalesce(1).write.mode("append").parquet(folder)


def shape(results):
    """Results without what differs between a batch run and a landing."""
    return sorted((r.file_path, r.status, r.error, r.data, r.meta.text_length, r.meta.text_page_count) for r in results.collect())


def test_pages_over_three_files_give_the_result_of_the_batch_run(spark, tmp_path):
    first, second = paged("in/DA00001_Bids As Read.pdf", 5), paged("in/DA00002_Bids As Read.pdf", 3)
    files = [[first[0], first[3], second[1]], [first[1], first[1], second[0]], [first[4], first[2], second[2], second[0]]]
    folder = str(tmp_path / "land")
    for k in (2, 0, 1):
        land(spark, folder, files[k])
    done = run.ingest_landing(landing_stream(spark, folder, SPLIT, max_files=1), "r1", CONFIG)
    whole = run.process_documents(documents(spark.createDataFrame(first + second, SPLIT).select("file_path", "page_no", "text")), "r1", CONFIG)
    assert shape(done) == shape(whole)
    assert {r.data.contract_number: len(r.data.bidders) for r in done.collect()} == {"DA00001": 5, "DA00002": 3}


def test_pages_wait_over_runs_and_a_version_is_processed_once(spark, tmp_path):
    folder, home = str(tmp_path / "land"), str(tmp_path / "home")
    rows = paged("in/DA00001_Bids As Read.pdf", 3)
    ingest = lambda run_id: run.ingest_landing(landing_stream(spark, folder, SPLIT, max_files=1), run_id, CONFIG, home)
    land(spark, folder, rows[:2])
    assert ingest("r1").count() == 0, "two of three pages"
    land(spark, folder, rows[2:])
    assert [(r.meta.run_id, len(r.data.bidders), r.meta.file_hash) for r in ingest("r2").collect()] == [("r2", 3, "v1")]
    land(spark, folder, rows)  # an unchanged file that lands again, and a new version of it
    land(spark, folder, paged("in/DA00001_Bids As Read.pdf", 2, "v2"))
    assert sorted((r.meta.run_id, r.meta.file_hash, len(r.data.bidders)) for r in ingest("r3").collect()) == [("r2", "v1", 3), ("r3", "v2", 2)]


def test_documents_that_do_not_become_whole_fail_after_their_time(spark, tmp_path):
    folder, home = str(tmp_path / "land"), str(tmp_path / "home")
    ingest = lambda: run.ingest_landing(landing_stream(spark, folder, SPLIT), "r", CONFIG, home, hold="1 ms")
    land(spark, folder, paged("in/DA00001_Bids As Read.pdf", 3)[:2] + [("in/DA00003_Bids As Read.pdf", "v1", 0, "x", None)])
    assert ingest().count() == 0
    land(spark, folder, paged("in/DA00002_Bids As Read.pdf", 1))
    got = {r.file_path.split("/")[1][:7]: (r.status, r.error) for r in ingest().collect()}
    assert got == {"DA00001": ("failed", "2 of 3 pages arrived"), "DA00002": ("success", None),
                   "DA00003": ("failed", "1 of an unknown number of pages arrived")}


def test_awkward_pages(spark, tmp_path):
    folder = str(tmp_path / "land")
    rows = [("a", None, 0, None, 2), ("a", None, 1, "", None), ("b", "v", None, None, 0), ("c", "v", None, None, 1), ("c", "v", 0, "y", None),
            ("c", "v", 0, "x", None), (None, "v", 0, "x", 1), ("d", "v", -1, "x", 1)]
    long = [("e", "v", k, "t" * (k % 7), 1000) for k in range(1000)]
    land(spark, folder, rows + long[::2])
    land(spark, folder, long)
    use_rocksdb(spark)
    rows = collect_batches(whole_documents(landing_stream(spark, folder, SPLIT, max_files=1), None), lambda df: df, "awkward").collect()
    got = {}
    for r in rows:
        got.setdefault(r.file_path, []).append((r.page_no, r.text, r.page_error))
    assert got.pop("e") and sorted(x[0] for x in [(r.page_no,) for r in rows if r.file_path == "e"]) == list(range(1000))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {
        "a": [(0, "", None), (1, "", None)], "b": [(None, None, "no pages")], "c": [(0, "x", None)]}
    for a, b in itertools.pairwise(sorted(r.page_no for r in rows if r.file_path == "e")):
        assert b == a + 1
