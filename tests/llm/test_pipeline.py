"""The pipeline against a plain version of each stage, on a given table and on awkward rows."""

import re

import corpus_pipeline as cp
from bidloom.llm import mixing, quality, secrets
from bidloom.llm.queries import table

from .common import awkward_rows
from .test_scans import plain_spans
from .test_simhash import plain_fingerprint, plain_roots

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [tuple(r[c] for c in cp.COLUMNS) for r in df.collect()]


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def plain_dedup(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_roots(set(prints))
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[roots[p]] = min(least.get(roots[p], r[0]), r[0])
    return {(r[0], r[1]) for r, p in zip(rows, prints) if r[0] is not None and least[roots[p]] == r[0]}


def plain_contaminated(text, items):
    words_of = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    words, hit = words_of(text), set()
    for item in items:
        w = words_of(item)
        n = min(13, len(w))
        windows = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if w else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i:i + n]) in windows:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_stages_equal_plain_versions(spark):
    docs = table(spark, SF_DIR, "documents")
    stages = dict(cp.STAGES)
    assert [n for n, _ in cp.STAGES] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "secret scan", "mixing"]
    good = cp.materialise(stages["quality classifier"](spark, docs, SF_DIR), "test")
    accepted = {r.doc_id for r in quality.quality(docs, table(spark, SF_DIR, "labels")).collect() if r.predicted}
    assert sorted(r[0] for r in rows_of(good)) == sorted(accepted)
    single = cp.materialise(stages["simhash near-dedup"](spark, good, SF_DIR), "test")
    assert sorted((r[0], r[1]) for r in rows_of(single)) == sorted(plain_dedup(rows_of(good)))
    clean = cp.materialise(stages["benchmark decontamination"](spark, single, SF_DIR), "test")
    items = [r.text for r in table(spark, SF_DIR, "benchmark").collect()]
    assert sorted(r[0] for r in rows_of(clean)) == sorted(r[0] for r in rows_of(single) if not plain_contaminated(r[1], items))
    masked = cp.materialise(stages["secret scan"](spark, clean, SF_DIR), "test")
    before, after = {r[0]: r[1] for r in rows_of(clean)}, {r[0]: r for r in rows_of(masked)}
    assert before.keys() == after.keys()
    for doc_id, text in before.items():
        assert (after[doc_id][1] == text) == (not secrets.find_spans(text)) and after[doc_id][4] == len(after[doc_id][1])
        assert not plain_spans(after[doc_id][1])
    mixed = stages["mixing"](spark, masked, SF_DIR)
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(masked).collect() if r.size}
    assert {r.doc_id: r.copies for r in mixed.collect()} == {k: n for k, n in taken.items() if n}
    assert sorted(map(key, rows_of(cp.run(spark, SF_DIR)))) == sorted(map(key, rows_of(mixed)))


def test_awkward_rows_pass_every_stage(spark):
    rows = awkward_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    single = rows_of(cp.dedup_stage(spark, docs, SF_DIR))
    with_id = sorted((r[0], r[1] or "") for r in single if r[0] is not None)
    assert with_id == sorted((a, b or "") for a, b in plain_dedup(rows))
    for name, stage in cp.STAGES:
        assert stage(spark, docs, SF_DIR).count() <= len(rows), name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name
