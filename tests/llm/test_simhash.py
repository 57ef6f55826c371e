import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from bidloom.llm import bitslice, simhash, stars

from .common import awkward_rows, empty, frame


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def plain_roots(values, radius=3):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= radius:
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in root}


def variants(rng, n):
    """Near fingerprints in chains and clouds, and far ones."""
    out = set()
    while len(out) < n:
        v = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 40)):
            out.add(v)
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                v ^= 1 << b
    return sorted(out)[:n]


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_fingerprints_of_texts_longer_than_a_count(monkeypatch):
    text = " ".join(random.Random(4).choices(["a", "Bc", "déf", "x1"], k=500))
    monkeypatch.setattr(simhash, "COUNTED", 7)
    for part in (text, text[:40], "one", "one two", ""):
        assert simhash.fingerprint(part.encode(), 3) == plain_fingerprint(part)


@pytest.mark.parametrize("bucket", [1024, 8])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    values = variants(random.Random(bucket), 700)
    values += [values[0] ^ (a << 50) for a in range(1, 300)]
    values = sorted(set(values))
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    got = {r.node: r.root for r in stars.components(simhash.links(df)).collect()}
    want = {}
    groups = {}
    for v, r in plain_roots(values).items():
        groups.setdefault(r, []).append(v)
    for members in groups.values():
        if len(members) > 1:
            least = min(map(signed, members))
            want.update({signed(v): least for v in members if signed(v) != least})
    assert got == want


def test_bit_sliced_distances():
    rng = random.Random(1)
    values = np.array(variants(rng, 200), np.uint64)
    starts = np.array([0, 1, 66, 67, 150])
    a, b = bitslice._links(values, starts, 3)
    ends = [*starts[1:].tolist(), len(values)]
    pairs = set()
    for lo, hi in zip(starts.tolist(), ends):
        for v, r in plain_roots([int(x) for x in values[lo:hi]]).items():
            if v != r:
                pairs.add((v, r))
    assert {(int(x), int(y)) for x, y in zip(a, b)} == pairs


def test_groups_equal_brute_force(spark):
    rows = awkward_rows()
    rows += [(900 + i, " ".join(rows[110][1].split() * 3 + ["w%d" % i]), "en", "a", 1) for i in range(30)]
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_roots(set(prints))
    least = {}
    for (doc_id, *_), p in zip(rows, prints):
        if doc_id is not None:
            least[roots[p]] = min(least.get(roots[p], doc_id), doc_id)
    want = sorted((-1 if r[0] is None else r[0], f"{p:016x}", least.get(roots[p], -1)) for r, p in zip(rows, prints))
    got = simhash.near_duplicates(frame(spark, rows)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in got) == want
    assert simhash.near_duplicates(empty(spark)).collect() == []


def test_groups_without_ids_have_one_representative_fingerprint(spark):
    got = simhash.near_duplicates(frame(spark, [(None, "only text here", None, None, None)] * 2)).collect()
    assert [r.component_id for r in got] == [None, None] and all(r.representative for r in got)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001)], "a long, b long")
    got = {r.node: r.root for r in stars.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 2001: 2000}


def test_one_text_of_a_group_is_its_representative(spark):
    rows = [(5, "One two three four"), (5, "one two three four"), (5, "one two three four"), (6, "one TWO three four"),
            (None, "no id at all here"), (None, "No id at all here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = simhash.near_duplicates(docs).filter("representative").select("doc_id", "text_hash").distinct().collect()
    assert sorted(str(r.doc_id) for r in got) == ["5", "None"]
