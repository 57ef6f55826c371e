"""Queries with SQL, on the given tables and on awkward rows."""

import duckdb
import pytest

from bidloom.llm import decontaminate, mixing, queries, topk

from .common import awkward_rows, empty, frame

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "benchmark", "labels")


def rounded(rows):
    return sorted(tuple(round(x, 6) if isinstance(x, float) else (x is None, x if x is not None else 0) for x in r) for r in rows)


def compare(df, con, sql):
    relation = con.sql(sql)
    assert sorted(df.columns) == sorted(relation.columns)
    ours = [tuple(r[c] for c in relation.columns) for r in df.collect()]
    assert rounded(ours) == rounded(relation.fetchall())
    return ours


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    assert compare(queries.QUERIES[name](spark, SF_DIR), con, queries.SQL[name])


def awkward(tmp_path, spark, rows, name="documents"):
    con = duckdb.connect()
    frame(spark, rows).write.parquet(str(tmp_path / name))
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    return con


def test_mixing_of_awkward_rows(spark, tmp_path):
    rows = awkward_rows() + [(5000 + i, "w " * (i % 7), "en", "hot", 1) for i in range(400)] + [(9000, "", "en", "blank", 0)]
    con = awkward(tmp_path, spark, rows)
    got = compare(mixing.mix(frame(spark, rows)).drop("source"), con, queries.SQL["op6_mixing"])
    assert len(got) == len(rows)
    out = mixing.mixed_documents(frame(spark, rows))
    assert out.filter("copies > 3").count() == 0
    taken = mixing.mix(frame(spark, rows)).filter("source = 'hot'").agg({"taken": "sum", "target": "max"}).first()
    assert abs(taken[0] - taken[1]) <= 7
    assert mixing.mix(empty(spark)).collect() == [] and mixing.mixed_documents(empty(spark)).collect() == []


def test_mixing_divides_repeated_rows(spark, tmp_path):
    rows = [(1, "one two three", "en", "x", 1)] * 1000 + [(i, "w " * 30, "en", "y", 1) for i in range(100)]
    rows += [(3, "w " * 40, "en", None, 1)] * 50 + [(None, "five", "en", "x", 1)] * 10
    con = awkward(tmp_path, spark, rows)
    got = compare(mixing.mix(frame(spark, rows)).drop("source"), con, queries.SQL["op6_mixing"])
    assert len(got) == len(rows)
    for r in mixing.mix(frame(spark, rows)).groupBy("source").agg({"taken": "sum", "target": "max", "size": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= r["max(size)"] / 2 + 1e-6, r
    words = mixing.mix(frame(spark, rows)).filter("source IS NULL").agg({"taken": "sum"}).first()[0]
    assert mixing.mixed_documents(frame(spark, rows)).filter("source IS NULL").agg({"copies": "sum"}).first()[0] == words // 40


def test_decontamination_of_awkward_rows(spark, tmp_path):
    rows = awkward_rows()
    base = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma"
    rows += [(700, f"x {base.upper()}, y", None, None, None), (701, "Short-item!", None, None, None), (702, base.rsplit(" ", 6)[0], None, None, None),
             (703, "a a a a a a a a a a a a a a a a", None, None, None), (704, base + " pad" * 900, None, None, None)]
    items = [(1, base), (2, "short item"), (10, base[:60]), (None, "only null id"), (3, None), (4, " !! "), (5, "a " * 15), (5, "b c")]
    con = awkward(tmp_path, spark, rows)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", [i for i in items if i[0] is not None])
    bench = lambda some: spark.createDataFrame(some, "item_id long, text string")
    known = [i for i in items if i[0] is not None]
    got = decontaminate.contamination(frame(spark, rows), bench(known), slop=None).drop("text_hash", "n_near_items")
    compare(got, con, queries.SQL["op7_decontamination"])
    assert {r.doc_id for r in got.filter("contaminated").collect()} >= {700, 701, 703}
    assert got.filter("doc_id = 704").first().contaminated is False
    assert decontaminate.contamination(frame(spark, rows), bench(items)).count() == len(rows)
    assert decontaminate.contamination(frame(spark, rows), bench([])).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(empty(spark), bench(items)).collect() == []


def test_several_chunks_of_benchmark_give_the_same(spark, monkeypatch):
    docs, bench = queries.table(spark, SF_DIR, "documents"), queries.table(spark, SF_DIR, "benchmark")
    whole = sorted(map(str, decontaminate.contamination(docs, bench, slop=1).collect()))
    monkeypatch.setattr(decontaminate, "CHUNK_BYTES", 2000)
    assert sorted(map(str, decontaminate.contamination(docs, bench, slop=1).collect())) == whole


def test_near_matches(spark):
    item = " ".join(f"w{i}" for i in range(13))
    far = item.replace("w6", "w6 p q r")
    near = item.replace("w3", "w3 p").replace("w9", "w9 q")
    docs = frame(spark, [(1, item, None, None, None), (2, near, None, None, None), (3, far, None, None, None), (4, item[:30], None, None, None)])
    got = {r.doc_id: r.n_near_items for r in decontaminate.contamination(docs, spark.createDataFrame([(1, item)], "item_id long, text string"), slop=2).collect()}
    assert got == {1: 1, 2: 1, 3: 0, 4: 0}


def test_near_matches_do_not_run_over_documents(spark):
    docs = frame(spark, [(1, "alpha beta", None, None, None), (2, "gamma delta", None, None, None)], parts=1)
    bench = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    assert decontaminate.contamination(docs, bench, slop=decontaminate.GAP - 1).filter("n_near_items > 0").count() == 0
    for slop in (decontaminate.GAP, 80, -1):
        with pytest.raises(ValueError):
            decontaminate.contamination(docs, bench, slop=slop)


def test_topk_of_awkward_vectors(spark):
    import random

    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(500 + i, [0.5] * 6) for i in range(20)] + [(50, [0.25] * 6), (50, [0.25] * 6)]
    rows += [(600, None), (650, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (700, [float("nan")] * 6), (750, [float("inf")] * 6), (800, [1.0, 2.0]), (850, []), (None, [1.0] * 6)]
    df = spark.createDataFrame([(a, b, "clash", 1) for a, b in rows], "vec_id long, embedding array<double>, row string, q int").repartition(3)
    from math import floor, isfinite

    sound = [(i, [floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and isfinite(x) for x in v)]
    want = []
    for n, (i, v) in enumerate(sound):
        if i % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, (j, w) in enumerate(sound) if m != n and len(w) == len(v))
            want += [(i, k + 1, j, -s) for k, (s, j) in enumerate(scored[:5])]
    assert sorted(map(tuple, topk.exact_topk(df).collect())) == sorted(want)
    assert topk.exact_topk(df.limit(0)).collect() == []
