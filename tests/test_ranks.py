"""Blocked ranks and quantiles against brute force, with one group holding most rows."""

import random
import time
from decimal import Decimal

import numpy as np
from pyspark.sql import functions as F

from bidloom.functions import ranks
from bidloom.functions.ranks import blocked_quantiles, running_count, value_ranks
from bidloom.operators import report as R
from bidloom.operators import validate as V


def skewed(spark, n=3000, seed=1):
    rnd = random.Random(seed)
    rows = [("hot" if i % 3 else f"k{i % 40}", Decimal(rnd.choice([rnd.randint(-500, 500), rnd.randint(0, 10**13), 77])).scaleb(-2)) for i in range(n)]
    return rows, spark.createDataFrame(rows + [("nul", None)], "k string, v decimal(18,2)").repartition(6)


def test_quantiles_equal_numpy(spark):
    rows, df = skewed(spark)
    probs = {"a": 0.25, "m": 0.5, "z": 1.0, "o": 0.0, "p": 0.9}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(float(v))
    have = {r.k: r for r in blocked_quantiles(df, ["k"], "v", probs).collect()}
    assert set(have) == set(groups)
    for k, values in groups.items():
        assert have[k].n == len(values) and have[k].lowest == min(values) and have[k].highest == max(values)
        assert np.isclose(have[k].mean, np.mean(values))
        for name, p in probs.items():
            assert np.isclose(have[k][name], np.quantile(values, p), rtol=1e-12, atol=1e-9), (k, name)


def test_whole_table_quantile(spark):
    rows, df = skewed(spark, 500)
    got = R.award_stats(df.select(F.col("v").alias("awarded_amount"))).first()
    values = [float(v) for _, v in rows]
    assert (got["count"], got["min"], got["max"]) == (500, min(values), max(values)) and np.isclose(got["median"], np.median(values))


def test_running_count(spark):
    rnd = random.Random(2)
    rows = [("hot" if i % 4 else f"k{i % 9}", i, rnd.random() < 0.6) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, p int, f boolean").repartition(5)
    seen, want = {}, {}
    for k, p, f in rows:
        seen[k] = seen.get(k, 0) + f
        want[p] = seen[k]
    got = running_count(df, ["k"], "p", F.col("f"), "n", block=64)
    assert {r.p: r.n for r in got.collect()} == want


def test_outlier_rule_equals_numpy_for_groups_of_all_sizes(spark):
    rnd = random.Random(4)
    rows = [("hot" if i % 2 else f"c{i % 30}", f"b{i}", Decimal(rnd.randint(1, 10**6 if i % 17 == 0 else 10**4)).scaleb(-2)) for i in range(1500)]
    bidders = spark.createDataFrame(rows, "contract_number string, bidder_name string, total_bid_amount decimal(15,2)")
    contracts = bidders.select("contract_number").distinct()
    found = V.bidder_outliers(contracts, bidders).collect()
    assert any(not r.valid for r in found)
    for r in found:
        amounts = np.array([float(a) for k, _, a in rows if k == r.contract_number])
        q1, q3 = np.percentile(amounts, [25, 75])
        assert np.allclose((r.q1, r.q3), (q1, q3))
        assert r.outliers == ((amounts < q1 - 1.5 * (q3 - q1)) | (amounts > q3 + 1.5 * (q3 - q1))).sum()


def test_doubles_of_any_digits_and_special_values(spark):
    rnd = random.Random(7)
    rows = [("t", 0.051), ("t", 0.0745), ("t", -0.0), ("t", 0.0), ("t", float("nan")), ("t", None), ("u", float("inf")), ("u", -1e300), ("u", 5e-324)]
    rows += [("big", rnd.lognormvariate(0, 9)) for _ in range(2000)]
    times = spark.createDataFrame(rows, "k string, v double").repartition(4)
    ranked = value_ranks(times, ["k"], "v")
    assert [(r._v, r._n, r._first, r._rows) for r in ranked.where("k = 't'").orderBy("_v").collect()] == [(0.0, 2, 0, 4), (0.051, 1, 2, 4), (0.0745, 1, 3, 4)]
    assert [(r._v, r._first) for r in ranked.where("k = 'u'").orderBy("_v").collect()] == [(-1e300, 0), (5e-324, 1), (float("inf"), 2)]
    quartiles = {r.k: (r.a, r.b) for r in blocked_quantiles(times.where("k = 'big'"), ["k"], "v", {"a": 0.25, "b": 0.9}).collect()}
    assert np.allclose(quartiles["big"], np.quantile([v for k, v in rows if k == "big"], [0.25, 0.9]), rtol=1e-12)


def test_large_groups_are_cut_at_their_quantiles_and_ranks_stay_exact(spark, monkeypatch):
    monkeypatch.setattr(ranks, "BLOCK", 50)
    monkeypatch.setattr(ranks, "PARTS", 16)
    rows, df = skewed(spark)
    values = {}
    for k, v in rows:
        values.setdefault(k, []).append(v)
    found = value_ranks(df, ["k"], "v").collect()
    assert sum(r._n for r in found) == len(rows)
    for r in found:
        assert (r._first, r._rows, r._n) == (sum(v < r._v for v in values[r.k]), len(values[r.k]), values[r.k].count(r._v))
    whole = value_ranks(df, [], "v").collect()
    every = sorted(v for _, v in rows)
    assert all(r._first == sum(v < r._v for v in every) and r._rows == len(every) for r in whole)


def test_item_sums_of_long_lists_take_seconds(spark):
    n = 20_000
    lists = spark.range(1).select(
        F.expr(f"transform(sequence(1, {n}), i -> named_struct('bidder_name', concat('B', i % 9973), 'total_bid_amount', cast(i as decimal(18,2))))").alias("bidders"),
        F.expr(f"transform(sequence(1, {n}), i -> named_struct('bidder_name', concat('B', i % 9973), 'total_price', cast(1 as decimal(18,2))))").alias("items"))
    start = time.perf_counter()
    verdict = lists.select(V.items_rule(F.col("bidders"), F.col("items")).alias("v")).first().v
    assert time.perf_counter() - start < 20
    sums = {f"B{k}": len(range(k or 9973, n + 1, 9973)) for k in range(9973)}
    wrong = [(f"B{i % 9973}", i) for i in range(1, n + 1) if abs(i - sums[f"B{i % 9973}"]) > 1]
    texts = verdict.message.removeprefix("Bid items sum mismatch: ").split("; ")
    assert not verdict.valid and [t.split(":")[0] for t in texts] == [name for name, _ in wrong][:len(texts)] and len(texts) >= n - 10


def test_histogram_and_box(spark):
    values = [Decimal(i) for i in range(101)] + [None]
    df = spark.createDataFrame([("t", v) for v in values], "document_type string, awarded_amount decimal(15,2)")
    bins = {r.bin: r.frequency for r in R.award_histogram(df).collect()}
    want, _ = np.histogram([float(v) for v in values if v is not None], bins=20)
    assert [bins[i] for i in range(20)] == list(want)
    far = df.union(spark.createDataFrame([("t", Decimal(1000))], df.schema))
    box = R.boxplot_by_type(far, "awarded_amount").first()
    assert (box.whisker_low, box.whisker_high, box.outliers) == (0.0, 100.0, 1)
    assert R.award_histogram(df.where("awarded_amount is null")).count() == 0
    flat = R.award_histogram(df.where("awarded_amount = 5")).collect()
    assert sum(r.frequency for r in flat) == 1
