"""Text quality by Bradley-Terry ranking: weights learnt from pairs of a better and a worse document."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise
from .blocks import fold, small

#: Preference pairs drawn from a list of texts (`Ranking`).
PAIRS = 200_000
#: Labelled documents of a block, pairs that each takes part in at least, and documents of the rarer label that a block has at least.
BLOCK_ROWS, DRAWS, LEAST = 4096, 8, 32
#: Bins that a range of scores is cut into for the quantile, and rows in which the sums of the blocks come to the driver.
BINS, SUMS = 4096, 16
#: Words of a window in which repeats are counted.
WINDOW = 100

_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#$%&*+<=>@[]^_`{|}~\\/"
_MARK = b"!?"
_STOP = b".,;:"
_TAIL = re.compile(rb"[#$%&*!?~^=+|]{2,}(?=\s|\Z)")


def _share(data: bytes, letters: bytes) -> float:
    return (len(data) - len(data.translate(None, letters))) / len(data)


def features(text: str | None) -> list[float]:
    """Shares that describe a text, from characters, words, neighbouring words and lines, each also as its square root.

    None of them jumps at a length. Variety is measured twice: repeats within windows of `WINDOW` words of the whole text, and the
    logarithm of all different words against that of all words, so that a text of many copies of itself is not varied."""
    words = text.split() if text else []
    if not words:
        return [0.0] * (2 * N_SHARES)
    data, n = text.encode(), len(words)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    later = lambda k: sum(map(eq, words, words[k:])) / max(1, n - k)
    shares = [
        sum(map(str.isupper, words)) / n,
        sum(w.isalpha() for w in counts.keys() & _ONE_SIGN) / n,
        sum(counts[w] for w in counts.keys() & _ONE_SIGN) / n,
        min(1.0, len(_TAIL.findall(data)) / n),
        later(1), later(2), later(3),
        (max(counts.values()) - 1) / (n + 20),
        _share(data, _UPPER), _share(data, _DIGIT), _share(data, _SYMBOL), _share(data, _MARK), _share(data, _STOP),
        sum(counts[w] for w in counts if len(w) <= 3) / n,
        sum(counts[w] for w in counts if len(w) > 14) / n,
        min(1.0, (len(text) / n) / 30),
        (len(lines) - len(set(lines))) / (len(lines) + 2),
        1 - sum(len(set(words[k:k + WINDOW])) for k in range(0, n, WINDOW)) / n,
        1 - math.log1p(len(counts)) / math.log1p(n),
        min(1.0, math.log1p(n) / 12),
    ]
    return shares + [math.sqrt(s) for s in shares]


_ONE_SIGN = frozenset("|#$%&*+<=>@^_~/\\-")
N_SHARES = 20


class Ranking:
    """Linear scores w.x from pairs: the logistic loss of w.(x_better - x_worse), then a map to (0, 1).

    The cut is a quantile: the share of worse documents among all labelled ones, on the scores of the sample weighted back to the
    labels. The map gives a document at the cut the score `at_cut` and its slope follows the spread of the scores.
    """

    def __init__(self, sample: list[tuple[str, int]], worse_share: float, at_cut: float, seed: int = 5):
        self.at_cut = at_cut
        x = np.array([features(t) for t, _ in sample], float).reshape(len(sample), 2 * N_SHARES)
        y = np.array([label for _, label in sample])
        self.mean, self.scale, self.w, self.cut, self.slope = np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), -1.0, 1.0
        if not (y == 1).any() or not (y == 0).any():
            return
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        z = (x - self.mean) / self.scale
        rng = np.random.default_rng(seed)
        better, worse = z[y == 1], z[y == 0]
        self.w = bradley_terry(better[rng.integers(0, len(better), PAIRS)] - worse[rng.integers(0, len(worse), PAIRS)])
        raw = z @ self.w
        weight = np.where(y == 1, (1 - worse_share) / (y == 1).sum(), worse_share / (y == 0).sum())
        self.cut = weighted_cut(raw, weight, worse_share)
        self.slope = 4 / max(1e-6, float(raw[y == 1].mean() - raw[y == 0].mean()))

    @classmethod
    def of(cls, at_cut: float, **learnt) -> Ranking:
        """With values learnt elsewhere: `mean`, `scale`, `w`, `cut` and `slope`."""
        ranking = cls([], 0.0, at_cut)
        ranking.__dict__.update(learnt)
        return ranking

    def scores(self, x: np.ndarray) -> np.ndarray:
        raw = (x - self.mean) / self.scale @ self.w
        logit = self.slope * (raw - self.cut) + math.log(self.at_cut / (1 - self.at_cut))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


STEPS, RIDGE = 15, 1e-4


def pair_sums(differences: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over pairs for a Newton step on log(1 + exp(-w.d)): gradient and Hessian."""
    p = 1 / (1 + np.exp(np.clip(differences @ w, -30, 30)))
    return differences.T @ p, (differences * (p * (1 - p))[:, None]).T @ differences


def newton_step(w: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    return np.linalg.solve(hessian + ridge * np.eye(len(w)), gradient - ridge * w)


def bradley_terry(differences: np.ndarray, ridge: float = RIDGE, steps: int = STEPS) -> np.ndarray:
    """Newton steps on the mean of log(1 + exp(-w.d)) plus a ridge."""
    w = np.zeros(differences.shape[1])
    for _ in range(steps):
        gradient, hessian = (s / len(differences) for s in pair_sums(differences, w))
        w = w + newton_step(w, gradient, hessian, ridge)
    return w


def weighted_cut(raw: np.ndarray, weight: np.ndarray, share: float) -> float:
    """Midpoint of the gap between the scores on both sides of the weighted quantile."""
    order = np.argsort(raw, kind="stable")
    below = int(np.searchsorted(np.cumsum(weight[order]), share * weight.sum() * (1 + 1e-9), side="right"))
    values = raw[order]
    return float((values[max(0, below - 1)] + values[min(below, len(values) - 1)]) / 2)


def _payloads(blocks: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """number, features, labels and whether a row is no copy, for each written block."""
    for batch in blocks:
        for number, x, y, own in zip(*(batch.column(c).to_pylist() for c in ("block", "x", "y", "own"))):
            yield number, np.frombuffer(x).reshape(-1, 2 * N_SHARES), np.frombuffer(y, np.int8), np.frombuffer(own, np.int8) == 1


def _block(rows: pa.Table) -> pa.Table:
    """One row for a block, its documents in an order that depends on nothing but them."""
    rows = rows.sort_by([("h", "ascending"), ("y", "ascending"), ("copy", "ascending")])
    columns = [np.stack(rows.column("x").to_numpy()).astype(float), rows.column("y").to_numpy().astype(np.int8),
               (rows.column("copy").to_numpy() == 0).astype(np.int8)]
    return pa.table({"block": rows.column("block")[:1], **{c: pa.array([v.tobytes()], pa.binary()) for c, v in zip(("x", "y", "own"), columns)}})


def _summed(blocks: DataFrame, of: Callable[[int, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all blocks of the vector that `of` makes of one, always added in the same order."""
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, *block in _payloads(batches):
            yield pa.RecordBatch.from_pydict({"part": pa.array([number % SUMS]), "block": pa.array([number]), "v": pa.array([of(number, *block)])})

    def add(rows: pa.Table) -> pa.Table:
        total = np.stack(rows.sort_by("block").column("v").to_numpy()).sum(0)
        return pa.table({"part": rows.column("part")[:1], "v": pa.array([total])})

    parted = blocks.mapInArrow(parts, "part long, block long, v array<double>")
    rows = parted.groupBy("part").applyInArrow(add, "part long, v array<double>").collect()
    return np.sum([r.v for r in sorted(rows)], axis=0)


def _differences(number: int, z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """better - worse for the pairs of a block; each document is in DRAWS of them at least, if the block has both labels."""
    better, worse = z[y == 1], z[y == 0]
    if not len(better) or not len(worse):
        return z[:0]
    rng, n = np.random.default_rng((5, number)), max(len(better), len(worse))
    draw = lambda k: np.concatenate([np.resize(rng.permutation(k), n) for _ in range(DRAWS)])
    return better[draw(len(better))] - worse[draw(len(worse))]


def distributed_cut(raw: DataFrame, weight: dict[int, float], share: float) -> float:
    """`weighted_cut` of `raw(v, y)` with a weight for each label, exact: the range around the quantile is cut into BINS until its bin is one value."""
    low, high = raw.agg(F.min("v"), F.max("v")).first()
    limit, below, previous = share * (1 + 1e-9), 0.0, None
    while True:
        wide = high - low
        at = F.floor((F.col("v") - F.lit(low)) / F.lit(wide) * BINS) if wide > 0 else F.lit(0)
        bins = raw.filter(F.col("v").between(low, high)).groupBy(at.alias("bin")).agg(
            F.min("v").alias("low"), F.max("v").alias("high"), *(F.sum(F.when(F.col("y") == y, 1).otherwise(0)).alias(f"n{y}") for y in (0, 1))).collect()
        for b in sorted(bins, key=lambda b: b.low):
            here = weight[0] * b.n0 + weight[1] * b.n1
            if below + here > limit:
                break
            below, previous = below + here, b.high
        else:
            return high
        if b.low == b.high or len(bins) == 1:
            least = min(weight[y] for y in (0, 1) if b[f"n{y}"])
            return b.low if previous is None or below + least <= limit else (previous + b.low) / 2
        low, high = b.low, b.high


def _scorer(ranking: Ranking, held_fold: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x = np.array([features(t) for t in batch.column("text").to_pylist()], float).reshape(batch.num_rows, 2 * N_SHARES)
            scores = ranking.scores(x)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "held_out": pa.array(batch.column("fold").to_numpy() == held_fold),
                "score": pa.array(scores), "predicted": pa.array((scores >= ranking.at_cut).astype(np.int32))})
    return score


def _keeper(ranking: Ranking):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x = np.array([features(t) for t in batch.column("text").to_pylist()], float).reshape(batch.num_rows, 2 * N_SHARES)
            yield batch.filter(pa.array(ranking.scores(x) >= ranking.at_cut))
    return keep


def learnt_blocks(documents: DataFrame, labels: DataFrame, learn: Column) -> DataFrame | None:
    """All documents with a label among the rows of `labels` where `learn` holds, as written blocks of their features; none without both labels.

    Null ids and null texts are left out; an id that is labelled twice has the larger label, and one with several texts is learnt with
    that of the smallest hash. Copies of a text count once for each label. Texts become features where they lie, whatever their length."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & learn).groupBy("doc_id").agg(F.max("y").alias("y"))

    def shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            x = pa.array([features(t) for t in batch.column("text").to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "h": batch.column("h"), "x": x})

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h")).filter(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & learn)
    rows = texts.mapInArrow(shares, "doc_id long, h long, x array<double>").join(y, "doc_id")
    rows = rows.groupBy("doc_id", "y").agg(F.min(F.struct("h", "x")).alias("t"))
    rows = rows.groupBy(F.col("t.h").alias("h"), "y").agg(F.min("t.x").alias("x"))
    # as many files as there will be blocks or so, however many partitions the shuffle has: each file costs its task several processes
    rows = materialise(rows.coalesce(math.ceil(max(1, y.count()) / BLOCK_ROWS)), "quality-labelled")
    n = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(n) < 2:
        return None
    many = math.ceil(sum(n.values()) / BLOCK_ROWS)
    rarer = min(n, key=n.get)
    times = min(many, math.ceil(LEAST * many / n[rarer])) if many > 1 else 1
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("y") == rarer, times - 1).otherwise(0)))
    dealt = rows.select("*", copies.alias("copy")).withColumn("block", F.pmod(F.col("h") + F.col("copy"), F.lit(many)).cast("long"))
    return materialise(dealt.groupBy("block").applyInArrow(_block, "block long, x binary, y binary, own binary"), "quality-blocks")


def fit(documents: DataFrame, labels: DataFrame, held_fold: int = 0, cut: float = 0.3) -> Ranking:
    """The ranking learnt from all rows of `labels(doc_id, quality)` whose id has crc32 modulo 5 other than `held_fold`.

    Means, Newton steps and the cut are sums over blocks of documents, so the driver holds a few matrices however many labels there
    are. The share of worse documents is counted over all those rows. Without labels, or with one label only, every text scores
    above the cut."""
    learn = fold(F.col("doc_id"), 5) != held_fold
    blocks = learnt_blocks(documents, labels, learn)
    if blocks is None:
        return Ranking([], 0.0, cut)
    y = F.col("quality").cast("int")
    share = labels.filter(learn & y.isin(0, 1)).agg(F.avg(1 - y)).first()[0]
    k = 2 * N_SHARES

    def moments(number: int, x: np.ndarray, y: np.ndarray, own: np.ndarray) -> np.ndarray:
        return np.concatenate([np.concatenate(([len(z)], z.sum(0), (z * z).sum(0))) for z in (x[own & (y == 0)], x[own & (y == 1)])])

    sums = _summed(blocks, moments).reshape(2, 1 + 2 * k)
    n = sums[:, 0]
    mean = sums[:, 1:1 + k].sum(0) / n.sum()
    scale = np.maximum(np.sqrt(np.maximum(0, sums[:, 1 + k:].sum(0) / n.sum() - mean * mean)), 1e-3)

    def newton(w: np.ndarray):
        def pull(number: int, x: np.ndarray, y: np.ndarray, own: np.ndarray) -> np.ndarray:
            d = _differences(number, (x - mean) / scale, y)
            return np.concatenate(([len(d)], *(part.ravel() for part in pair_sums(d, w))))
        return pull

    w = np.zeros(k)
    for _ in range(STEPS):
        sums_w = _summed(blocks, newton(w))
        move = newton_step(w, sums_w[1:1 + k] / sums_w[0], sums_w[1 + k:].reshape(k, k) / sums_w[0])
        w = w + move
        if np.abs(move).max() < 1e-9:
            break

    def raw_scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x, y, own in _payloads(batches):
            yield pa.RecordBatch.from_pydict({"v": pa.array((x[own] - mean) / scale @ w), "y": pa.array(y[own].astype(np.int32))})

    raw = materialise(blocks.mapInArrow(raw_scores, "v double, y int"), "quality-scores")
    apart = (sums[1, 1:1 + k] / n[1] - sums[0, 1:1 + k] / n[0]) / scale @ w
    return Ranking.of(
        cut, mean=mean, scale=scale, w=w, slope=4 / max(1e-6, float(apart)),
        cut=distributed_cut(raw, {0: share / n[0], 1: (1 - share) / n[1]}, share))


def quality(documents: DataFrame, labels: DataFrame, held_fold: int = 0, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of `documents(doc_id, text)`; see `fit` for what is learnt from.

    A score uses the text alone. Null and blank texts have all features 0 and are scored like any other. Null and repeated ids keep a
    row each (a null id counts as the empty text for the fold); an empty table gives an empty result; other columns are ignored;
    texts are scored whole.
    """
    rows = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text"), fold(F.col("doc_id"), 5).cast("int").alias("fold"))
    return rows.mapInArrow(
        _scorer(fit(documents, labels, held_fold, cut), held_fold),
        "doc_id long, text_hash long, held_out boolean, score double, predicted int").drop("text_hash")


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `documents` that the classifier accepts, with all their columns, repeated rows as often as they are there. An empty
    table gives an empty result; other columns are not read, whatever their names."""
    return documents.mapInArrow(_keeper(fit(documents, labels)), documents.schema)
