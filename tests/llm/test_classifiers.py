import pickle
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from bidloom.llm import quality, toxicity
from bidloom.llm.queries import QUERIES, table
from bidloom.llm.samples import labelled_sample

from .common import awkward_rows, empty, frame

SF_DIR = "/root/testdata/sf0.1"


def held_out_errors(spark, name, label):
    scored = QUERIES[name](spark, SF_DIR).filter("held_out")
    y = table(spark, SF_DIR, "labels").select("doc_id", label)
    rows = scored.join(y, "doc_id").collect()
    assert len(rows) > 50
    return sum(r.predicted != r[label] for r in rows) / len(rows)


def test_held_out_accuracy(spark):
    assert held_out_errors(spark, "op3_toxicity", "toxic") < 0.04
    assert held_out_errors(spark, "op8_quality", "quality") < 0.04


def test_nearest_equals_all_cosines():
    rng = random.Random(4)
    words = [f"word{i:03d}" for i in range(60)]
    bad = [f"vile{i}" for i in range(12)]
    sample = []
    for i in range(500):
        y = i % 4 == 0
        sample.append((" ".join(rng.choices(words, k=20) + (rng.choices(bad, k=5) if y else rng.choices(bad, k=i % 50 == 1))), int(y)))
    examples = toxicity.Examples(sample)
    kept = [i for i, (t, _) in enumerate(sample) if any(x in examples.terms for w in toxicity.words_of(t) for x in toxicity.terms_of_word(w))]
    dense = np.zeros((len(kept), len(examples.terms)))

    def vector(text):
        tf = {}
        for w in toxicity.words_of(text):
            for x in toxicity.terms_of_word(w):
                if x in examples.terms:
                    tf[examples.terms[x]] = tf.get(examples.terms[x], 0) + 1
        return examples.vector(tf)

    for row, i in enumerate(kept):
        ids, w = vector(sample[i][0])
        dense[row, ids] = w
    for i in range(0, 500, 7):
        ids, w = vector(sample[i][0])
        if len(ids):
            q = np.zeros(len(examples.terms))
            q[ids] = w
            cosines = dense @ q
            want = np.lexsort((np.arange(len(kept)), -np.round(cosines, 12)))[:toxicity.NEIGHBOURS]
            want = want[cosines[want] > 0]
            rows, found = examples.nearest(ids, w)
            assert rows.tolist() == want.tolist() and np.allclose(found, cosines[want])


def test_block_maxima_lose_no_neighbour():
    rng = random.Random(6)
    words, bad = [f"{a}{b}{c}" for a in "bdfgklm" for b in "aeiou" for c in ("lm", "rn", "st", "ck")], [f"vile{i}" for i in range(9)]
    sample = [(" ".join(rng.choices(words, k=rng.randrange(3, 60)) + rng.choices(bad, k=rng.randrange(4) * (i % 5 == 0))), int(i % 5 == 0)) for i in range(700)]
    sample += [sample[k] for k in range(0, 700, 50)]  # ties
    texts = [" ".join(rng.choices(words, k=n) + rng.choices(bad, k=n % 3)) for n in range(1, 70)] + ["", "unknown", sample[3][0]]
    examples = pickle.loads(pickle.dumps(toxicity.Examples(sample)))  # as the tasks get them
    vectors = [examples.vector_of(t, {}) for t in texts]
    dense = np.zeros((len(sample), len(examples.terms)))
    for row, (text, _) in enumerate(sample):
        ids, w = examples.vector_of(text, {})
        dense[row, ids] = w
    for most_open in (1, 4, 1000):  # all texts, some and none meet every example
        toxicity.MOST_OPEN, kept = most_open, toxicity.MOST_OPEN
        scored = examples.score(vectors)
        toxicity.MOST_OPEN = kept
        for (ids, w), (score, rows, found) in zip(vectors, scored):
            cosines = dense[:, ids] @ w
            want = np.lexsort((np.arange(len(sample)), -np.round(cosines, 12)))[:toxicity.NEIGHBOURS]
            want = want[cosines[want] > 0]
            assert rows.tolist() == want.tolist() and np.allclose(found, cosines[want], atol=1e-12)
            votes = [sum(cosines[r] ** 2 for r in want if sample[r][1] == y) for y in (0, 1)]
            base = (sum(y for _, y in sample) + 0.5) / (len(sample) + 1)
            odds = examples.slope * np.log((votes[1] + base) / (votes[0] + 1 - base)) + examples.shift
            assert abs(score - (1 / (1 + np.exp(-odds)) if len(want) else examples.silent)) < 1e-9


def test_bounds_are_left_out_where_they_close_nothing(monkeypatch):
    rng = random.Random(5)
    words = [f"word{i}" for i in range(60)]
    text = lambda: " ".join(rng.choices(words, k=40))
    examples = toxicity.Examples([(text(), i % 2) for i in range(400)])
    vectors = [examples.vector_of(text(), {}) for _ in range(40)]
    alone = [examples.nearest(*v) for v in vectors]
    calls, kth = [], toxicity._kth
    monkeypatch.setattr(toxicity, "_kth", lambda values, k: calls.append(len(values)) or kth(values, k))
    together = examples.search(vectors)
    assert len(calls) == len(vectors) + toxicity.TRIED  # one for the end of each search, one for each text that is bounded
    for (rows, cosines), (others, same) in zip(together, alone):
        assert rows.tolist() == others.tolist() and np.allclose(cosines, same, rtol=0, atol=1e-12)


def test_places_of_ranges():
    examples = toxicity.Examples([("one two", 0), ("two three", 1)])
    for first, last in (([3], [4]), ([5, 0, 2], [9, 1, 4]), ([0, 1, 2], [1, 2, 30])):
        places, sizes = examples._places(np.array(first), np.array(last))
        assert places.tolist() == [x for a, b in zip(first, last) for x in range(a, b)]
        assert sizes.tolist() == [b - a for a, b in zip(first, last)]


def test_examples_left_out_one_each():
    sample = [(f"word{i % 7} other{i % 5} more{i % 3}", i % 2) for i in range(60)]
    examples = toxicity.Examples(sample)
    vectors = [examples.vector_of(text, {}) for text, _ in sample[:9]]
    for i, (rows, _) in enumerate(examples.search(vectors, k=60, without=range(9))):
        assert i not in rows and rows.tolist() == [r for r in examples.search([vectors[i]], k=60)[0][0] if r != i]


def test_awkward_rows_and_missing_labels(spark):
    rows = awkward_rows()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(100)] + [(None, 1, True), (4, None, None)], "doc_id long, quality int, toxic boolean")
    none = labels.limit(0)
    for make in (toxicity.toxicity, quality.quality):
        for y in (labels, none):
            got = make(docs, y).collect()
            assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
        assert make(empty(spark), labels).collect() == []


def test_labels_of_the_held_out_fold_are_not_learnt(spark):
    import zlib

    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    flipped = spark.createDataFrame(
        [(r.doc_id, 1 - r.quality, 1 - r.toxic) if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 else tuple(r) for r in labels.collect()], labels.schema)
    pick = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert pick(toxicity.toxicity(docs, labels)) == pick(toxicity.toxicity(docs, flipped))


def test_bradley_terry_ranks():
    rng = np.random.default_rng(1)
    better, worse = rng.normal(0.5, 1, (5000, 3)), rng.normal(0, 1, (5000, 3))
    w = quality.bradley_terry(better - worse)
    assert (w > 0).all() and np.allclose(w, w.mean(), rtol=0.25)
    assert quality.weighted_cut(np.array([1.0, 2, 3, 4]), np.ones(4), 0.5) == 2.5


def plain_features(text):
    """The shares that replaced switches, counted word by word."""
    words = (text or "").split()
    n, repeats = len(words), 0
    for k in range(n):
        repeats += words[k] in words[k - k % 100:k]
    lines = [x for x in (text or "").split("\n") if x.strip()]
    again = sum(x in lines[:k] for k, x in enumerate(lines))
    most = max(words.count(w) for w in words)
    different = sum(w not in words[:k] for k, w in enumerate(words))
    return [(most - 1) / (n + 20), again / (len(lines) + 2), repeats / n, 1 - np.log(different + 1) / np.log(n + 1)]


def test_measures_of_repetition():
    rng = random.Random(2)
    for n in (1, 2, 19, 20, 99, 100, 101, 399, 400, 401, 900):
        text = "".join(rng.choice(["a", "bc", "def", "ghij", "k1", "l-m"]) + rng.choice([" ", " ", "\n"]) for _ in range(n))
        got = quality.features(text)
        assert np.allclose([got[7], got[16], got[17], got[18]], plain_features(text)), n
    varied = " ".join(f"word{i}" for i in range(398))
    before, after = (np.array(quality.features(varied + " x" * k)) for k in (1, 3))
    assert np.abs(before - after).max() < 0.1
    once = " ".join(rng.choice(["tree", "house", "river", "stone"]) + str(rng.randrange(300)) for _ in range(350))
    first, tenfold = quality.features(once), quality.features(" ".join([once] * 10))
    assert all(tenfold[k] >= first[k] for k in (7, 16, 18)) and tenfold[18] > first[18] + 0.1 and abs(tenfold[17] - first[17]) < 0.05


def test_weights_and_cut_equal_a_plain_fit():
    rng = random.Random(5)
    good = [" ".join(rng.choices(["river", "stone", "walked", "over", "the", "bridge"], k=rng.randrange(5, 60))) + "." for _ in range(60)]
    bad = [" ".join(rng.choices(["BUY", "NOW", "$$$", "click", "!!!"], k=rng.randrange(5, 60))) for _ in range(40)]
    sample = [(t, 1) for t in good] + [(t, 0) for t in bad]
    ranking = quality.Ranking(sample, 0.4, 0.3)
    x = (np.array([quality.features(t) for t, _ in sample]) - ranking.mean) / ranking.scale
    draw = np.random.default_rng(5)
    d = x[:60][draw.integers(0, 60, quality.PAIRS)] - x[60:][draw.integers(0, 40, quality.PAIRS)]
    pull = d.T @ (1 / (1 + np.exp(d @ ranking.w))) / len(d) - 1e-4 * ranking.w  # gradient of the loss is zero at its least
    assert np.abs(pull).max() < 1e-4
    raw = x @ ranking.w
    assert raw[60:].max() < ranking.cut < raw[:60].min()
    scores = ranking.scores(np.array([quality.features(t) for t, _ in sample]))
    assert ((scores >= 0.3) == (np.array([y for _, y in sample]) == 1)).all()


def test_rare_and_ordinary_words_find_their_neighbours(spark):
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in ("lm", "rn", "st")]
    learnt = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, " ".join(rng.choices(words, k=20))) for i in learnt]
    bad = set(learnt[5:8])
    rows = [(i, "grubmook " * 3 + t if i in bad else t) for i, t in rows]
    rows += [(1000, " ".join(rng.choices(words, k=15)) + " grubmook grubmook"), (1001, rows[20][1]), (1002, "quite unknown"), (1003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i in bad) for i in learnt], "doc_id long, toxic boolean")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert {n.label for n in got[1000].neighbours} == {1} and got[1000].predicted == 1
    assert abs(got[1001].neighbours[0].cosine - 1) < 1e-9 and got[1001].predicted == 0
    assert not got[1002].neighbours and not got[1003].neighbours and got[1002].score == got[1003].score


def test_a_sampled_id_on_many_rows_gives_one_text(spark):
    rows = [(1, f"text {i}") for i in range(300)] + [(2, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    sample = labelled_sample(docs, labels, "toxic", F.lit(True), {1: 5, 0: 5})
    assert len(sample) == 2 and sorted(y for _, y in sample) == [0, 1]


def test_quality_learns_from_every_label(spark, monkeypatch):
    """Blocks of a few rows, one worse document in fifty: each label counts, and the cut is that of all scores."""
    monkeypatch.setattr(quality, "BLOCK_ROWS", 40)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choices(["river", "Stone", "walked,", "over", "the", "bridge", "x9", "| "], k=rng.randrange(4, 50)))) for i in range(900)]
    labels = spark.createDataFrame([(i, int(i % 50 != 0)) for i, _ in rows], "doc_id long, quality int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    learnt = [(t, int(i % 50 != 0)) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    share = sum(1 - y for _, y in learnt) / len(learnt)
    blocks = quality.learnt_blocks(docs, labels, quality.fold(F.col("doc_id"), 5) != 0)
    parts = [p for b in blocks.toArrow().to_batches() for p in quality._payloads([b])]
    assert len(parts) > 10 and sum(int(own.sum()) for *_, own in parts) == len(set(learnt))
    assert all(len(quality._differences(n, x, y)) >= 8 * len(y[y == 1]) > 0 for n, x, y, _ in parts)
    ranking = quality.fit(docs, labels)
    x = np.array([quality.features(t) for t, _ in sorted(set(learnt))])
    y = np.array([y for _, y in sorted(set(learnt))])
    assert np.allclose(ranking.mean, x.mean(0)) and np.allclose(ranking.scale, np.maximum(x.std(0), 1e-3))
    raw = (x - ranking.mean) / ranking.scale @ ranking.w
    weight = np.where(y == 1, (1 - share) / (y == 1).sum(), share / (y == 0).sum())
    assert abs(ranking.cut - quality.weighted_cut(raw, weight, share)) < 1e-9
    assert (quality.fit(docs, labels).w == ranking.w).all()


def test_the_cut_is_found_in_bins(spark, monkeypatch):
    monkeypatch.setattr(quality, "BINS", 3)
    rng = np.random.default_rng(3)
    for v in (rng.normal(size=200), np.round(rng.normal(size=200)), np.zeros(5), np.array([1.0, 2, 3, 4])):
        df = spark.createDataFrame([(float(a), 1) for a in v], "v double, y int")
        for share in (0.0, 0.3, 0.5, 1.0):
            got = quality.distributed_cut(df, {0: 0.0, 1: 1 / len(v)}, share)
            assert abs(got - quality.weighted_cut(v, np.full(len(v), 1 / len(v)), share)) < 1e-12, (share, len(v))


def test_labelled_rows_are_written_in_as_many_files_as_they_fill(spark, monkeypatch):
    """However many partitions the shuffle has: files cost processes."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("some text "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    written, write = {}, quality.materialise

    def counted(df, purpose):
        done = write(df, purpose)
        written[purpose] = len(done.inputFiles())
        return done

    monkeypatch.setattr(quality, "materialise", counted)
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        quality.learnt_blocks(docs, labels, F.lit(True))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert written["quality-labelled"] == 1
