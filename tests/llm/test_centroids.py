import hashlib
import math
import random

import numpy as np
import pytest

from bidloom.llm import centroids
from bidloom.llm.centroids import Search

SCHEMA = "vec_id long, embedding array<float>, cluster string, v string, n int, sums string, distance string, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, x, "clash", "clash", 1, "clash", "clash", 2) for i, x in rows], SCHEMA).repartition(3)


def vectors(n, seed=1, dims=64):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(5, dims))
    return [(i, (middles[i % 5] + 0.3 * rng.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]


def plain(rows, k=16, rounds=3, dims=64, scale=64, seed=1):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    middles = [v for _, v in first]
    if not middles:
        return []
    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(middles))
    for _ in range(rounds):
        at = [nearest(v)[1] for _, v in kept]
        for c in range(len(middles)):
            own = [v for (_, v), a in zip(kept, at) if a == c]
            if own:
                middles = middles[:c] + [[sum(x) // len(own) for x in zip(*own)]] + middles[c + 1:]
    found = [(i, *nearest(v)) for i, v in kept]
    total = sum(d for _, d, _ in found)
    return [(i, c, d, sum(e for _, e, o in found if o == c), total, middles[c]) for i, d, c in found]


def rows_of(df):
    key = lambda r: tuple((x is None, x) for x in r[:3])
    return sorted((tuple(r) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid").collect()), key=key)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_search_is_exact_and_skips_centroids(seed):
    rng = np.random.default_rng(seed)
    middles = rng.integers(-40, 40, (50, 16)) + rng.integers(-200, 200, (50, 1))
    middles[7] = middles[3]  # a tie everywhere
    x = middles[rng.integers(0, 50, 3000)] + rng.integers(-6, 7, (3000, 16))
    at, distance, computed = Search(middles).nearest(x)
    every = ((x[:, None, :] - middles[None]) ** 2).sum(2)
    assert (at == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert computed < 0.2 * every.size


def test_search_with_equal_sums_wide_values_and_one_centroid():
    rng = np.random.default_rng(9)
    wide = centroids.WIDEST - 1
    middles = np.array([[wide, -wide], [-wide, wide], [0, 0], [1, -1], [0, 0], [wide, wide]])
    x = np.concatenate((middles, middles[::-1] // 2, rng.integers(-3, 4, (200, 2)), rng.integers(-wide, wide, (200, 2))))
    at, distance, _ = Search(middles).nearest(x)
    every = ((x[:, None, :] - middles[None]) ** 2).sum(2)
    assert (at == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert Search(middles[:1]).nearest(x)[0].tolist() == [0] * len(x)


def test_clusters_equal_the_plain_rounds_on_awkward_rows(spark):
    rows = vectors(150)
    rows += [(200, None), (201, []), (202, rows[0][1][:63]), (203, rows[0][1] + [0.0]), (204, [None] + rows[0][1][1:])]
    rows += [(205, [math.nan] + rows[0][1][1:]), (206, [math.inf] + rows[0][1][1:]), (None, rows[1][1]), (None, rows[1][1])]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (3, rows[4][1]), (207, [0.0] * 64), (208, [-0.001] * 64)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]
    random.Random(1).shuffle(rows)
    key = lambda r: tuple((x is None, x) for x in r[:3])
    assert rows_of(centroids.clusters(table(spark, rows))) == sorted(plain(rows), key=key)
    assert rows_of(centroids.clusters(table(spark, rows), k=3, rounds=1, seed=7)) == sorted(plain(rows, k=3, rounds=1, seed=7), key=key)


def test_few_vectors_and_none(spark):
    rows = vectors(5)
    assert rows_of(centroids.clusters(table(spark, rows))) == sorted(plain(rows))
    for none in ([], [(1, None), (2, [1.0])], [(None, rows[0][1])]):
        assert centroids.clusters(table(spark, none)).collect() == []


def test_components_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="do not lie|does not lie"):
        centroids.clusters(table(spark, [(1, [1e30] * 64)])).collect()
