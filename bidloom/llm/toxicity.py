"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, found in inverted lists over all terms of the examples."""

from __future__ import annotations

import hashlib
import math
import pickle
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .blocks import fold, local_ids, small
from .samples import labelled_sample

#: Most labelled documents learnt from, by label.
SAMPLE = {1: 2500, 0: 10000}
#: Neighbours that vote, most frequent terms that are bounded by block maxima, examples in a block, and texts that are searched together.
NEIGHBOURS, DENSE, BLOCK, TOGETHER = 15, 1024, 8, 64
#: More than rounding in single precision can do to a cosine; a text of which more than one in MOST_OPEN examples stays open meets them all.
SLACK, MOST_OPEN = 1e-5, 32
#: Texts of a search that are bounded whether bounds help or not.
TRIED = 8
#: A term weighs LEAST_WEIGHT to 1 + LEAST_WEIGHT times its TF-IDF, half way where chance explains one such term among all in 1 / CHANCE samples.
LEAST_WEIGHT, CHANCE = 0.02, 0.05
_EDGES = ".,;:!?\"'()[]{}<>*%&$#|~^_-+=/\\`…«»„“”‚‘’"

RESULT = "doc_id long, held_out boolean, score double, predicted int, neighbours array<struct<example: int, cosine: double, label: int>>"


def terms_of_word(word: str) -> tuple[str, ...]:
    """A word and its beginnings of 4, 5 and 6 letters, which stand for the forms of a stem."""
    core = word.strip(_EDGES)
    return (core, *(f"{core[:n]}-" for n in (4, 5, 6) if len(core) > n)) if core else ()


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Examples:
    """Unit TF-IDF vectors of labelled documents over all their terms, as inverted lists; lists of frequent terms have block maxima.

    TF-IDF is scaled by how surely a term goes with a label (log-likelihood ratio against the number of terms). The scale is never 0, so
    all terms take part. Only examples without words have a zero vector, cosine 0 with everything, and are not indexed.
    """

    def __init__(self, sample: list[tuple[str, int]]):
        y = np.array([label for _, label in sample], np.int8)
        self.base = (y.sum() + 0.5) / (len(y) + 1)
        numbers = local_ids()
        known: dict[str, bytes] = {}
        counts = [_counted(text, known, lambda word: tuple(numbers[t] for t in terms_of_word(word))) for text, _ in sample]
        del known
        n, ones = (
            sum((np.bincount(ids, minlength=len(numbers)) for (ids, _), label in zip(counts, y) if label in some), np.zeros(len(numbers)))
            for some in ((0, 1), (1,)))
        # terms are numbered by falling frequency
        names = list(numbers)
        del numbers
        order = np.array(sorted(range(len(names)), key=lambda i: (-n[i], names[i])), np.int64)
        self.terms = {names[i]: place for place, i in enumerate(order.tolist())}
        del names
        placed = np.empty(len(order), np.int32)
        placed[order] = np.arange(len(order), dtype=np.int32)
        n, ones = n[order], ones[order]
        for i, (ids, times) in enumerate(counts):
            ids = placed[ids]
            by_id = np.argsort(ids)
            counts[i] = ids[by_id], times[by_id]
        del order, placed
        self.idf = (np.log((1 + len(y)) / (1 + n)) + 1) * _certainty(n, ones, int(y.sum()), len(y))
        kept = [i for i, (ids, _) in enumerate(counts) if len(ids)]
        self.label = y[kept]
        # cosine 0 with all examples: the share of label 1 among all of them
        self.silent = (y.sum() + 0.5) / (len(y) + 10)
        counts = [counts[i] for i in kept]
        self._build(counts)
        self.slope, self.shift = self._calibrate(counts)

    def counts_of(self, text: str, known: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Terms of a text and their counts; `known` keeps the terms of words from text to text."""
        return _counted(text, known, lambda word: tuple(self.terms[t] for t in terms_of_word(word) if t in self.terms))

    def vector_of(self, text: str, known: dict[str, bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self._unit(*self.counts_of(text, known))

    def vector(self, tf: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        ids = sorted(tf)
        return self._unit(np.array(ids, np.int64), np.array([tf[i] for i in ids], float))

    def _unit(self, ids: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = self._raw(ids, tf)
        return ids, w / math.sqrt(w @ w) if len(w) else w

    def _raw(self, ids: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return (1 + np.log(tf)) * self.idf[ids]

    def _build(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        rows = np.repeat(np.arange(len(counts), dtype=np.uint16), [len(i) for i, _ in counts])
        ids = np.concatenate([i for i, _ in counts]).astype(np.int32) if counts else np.empty(0, np.int32)
        tf = np.concatenate([n for _, n in counts]) if counts else np.empty(0, np.int32)
        tf = tf.astype(np.min_scalar_type(int(tf.max(initial=0))))
        order = np.argsort(ids, kind="stable")
        self.norms = np.array([math.sqrt(w @ w) for w in (self._raw(*c) for c in counts)])
        self._lists(np.bincount(ids, minlength=len(self.terms)).astype(np.int32), rows[order], tf[order])

    def _lists(self, sizes: np.ndarray, rows: np.ndarray, tf: np.ndarray) -> None:
        """Lists of rare terms, those of counts above 1 with their logarithms; of the DENSE most frequent terms counts and weights by
        example, and block maxima."""
        self.sizes, self.rows, self.tf = sizes, rows, tf
        self.room = np.empty(0, np.int64)
        self.lists = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
        dense, blocks = min(DENSE, len(sizes)), -(-len(self.norms) // BLOCK)
        often = self.lists[dense]
        ids = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        several = np.flatnonzero(tf[often:] > 1) + often
        self.more = np.searchsorted(several, self.lists[dense:])
        # rounded as in `_raw`: of small integers numpy takes logarithms in half precision
        self.more_rows, self.more_logs = rows[several], (1 + np.log(tf[several])).astype(float) - 1
        self.counts = np.zeros((blocks * BLOCK, dense), tf.dtype)
        self.counts[rows[:often], ids[:often]] = tf[:often]
        self.often = np.zeros((blocks * BLOCK, dense), np.float32)
        self.often[rows[:often], ids[:often]] = self._raw(ids[:often], tf[:often]) / self.norms[rows[:often]]
        self.bounds = np.ascontiguousarray(self.often.reshape(blocks, BLOCK, dense).max(1).T)

    def __reduce__(self):
        """Sent to tasks as counts, compressed; lists, weights and maxima are made again once in each worker."""
        state = {k: getattr(self, k) for k in ("idf", "label", "base", "silent", "slope", "shift", "norms", "sizes", "rows", "tf")}
        data = zlib.compress(pickle.dumps(("\n".join(self.terms), state), 5), 1)
        return _unpacked, (hashlib.sha256(data).hexdigest(), data)

    def _rare_part(self, ids: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Sums over the lists of the rare terms of a vector, by block and place in the block.

        A posting weighs 1 + log(count), mostly 1: the logarithms are added from the lists of counts above 1, the norms divide the sums."""
        dense = self.often.shape[1]
        n = np.searchsorted(ids, dense)
        ids, w = ids[n:], w[n:] * self.idf[ids[n:]]
        sums = np.zeros(len(self.often))
        if len(ids):
            places, sizes = self._places(self.lists[ids], self.lists[ids + 1])
            sums = np.bincount(self.rows.take(places, mode="clip"), np.repeat(w, sizes), len(self.often))
        first, last = self.more[ids - dense], self.more[ids - dense + 1]
        some = first < last
        if some.any():
            places, sizes = self._places(first[some], last[some])
            sums += np.bincount(self.more_rows[places], np.repeat(w[some], sizes) * self.more_logs[places], len(self.often))
        sums[:len(self.norms)] /= self.norms
        return sums.reshape(-1, BLOCK)

    def _places(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the ranges from `first` to before `last`, none of them empty, one range after the other, and the sizes of the ranges.

        They are sums of steps: 1 inside a range, from the end of one to the start of the next between two. Memory is kept from text to
        text, as fresh memory costs more than the sums; the numbers hold until the next call."""
        sizes = last - first
        ends = np.cumsum(sizes)
        if ends[-1] > len(self.room):
            self.room = np.empty(int(ends[-1]) * 5 // 4, np.int64)
        places = self.room[:ends[-1]]
        places.fill(1)
        places[0] = first[0]
        places[ends[:-1]] = first[1:] - last[:-1] + 1
        return np.cumsum(places, out=places), sizes

    def _exact(self, rows: np.ndarray, ids: np.ndarray, w: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """Cosines with some examples in double precision, from counts."""
        n = np.searchsorted(ids, self.often.shape[1])
        tf = self.counts[rows[:, None], ids[:n]].astype(float)
        weights = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0.0) * self.idf[ids[:n]]
        return weights @ w[:n] / self.norms[rows] + rare.ravel()[rows]

    def search(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = NEIGHBOURS,
               without: Sequence[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the exact top k by cosine among those above 0, ties (12 digits) to the smaller example, leaving out one
        example each if `without` names them.

        The lists of rare terms are summed. For frequent terms the block maxima bound what a block of examples can add: the blocks of
        the largest bounds are opened first, their kth cosine closes all blocks and then all examples whose bound is below it. Where
        too many stay open, all examples are computed, several vectors in one product; bounds are left out once they did not help more
        than three in four of the vectors before, and TRIED at least. Single precision decides only beyond SLACK; what
        is left is computed in double precision."""
        if not len(self.norms):
            return [(np.empty(0, np.int64), np.empty(0))] * len(vectors)
        q = np.zeros((len(vectors), self.often.shape[1]), np.float32)
        for row, (ids, w) in enumerate(vectors):
            n = np.searchsorted(ids, q.shape[1])
            q[row, ids[:n]] = w[:n]
        limits = q @ self.bounds
        out: list = [None] * len(vectors)
        open_ones = []
        for row, (ids, w) in enumerate(vectors):
            rare = self._rare_part(ids, w)
            rare.ravel()[len(self.norms):] = -2
            if without is not None:
                rare.ravel()[without[row]] = -2
            if row >= TRIED and len(open_ones) * 4 > row * 3:
                open_ones.append((row, rare))
                continue
            limit = rare.max(1) + limits[row]
            n = min(len(limit), 2 * k // BLOCK + 2)
            best = np.argpartition(limit, -n)[-n:]
            least = _kth((rare[best] + (self.often.reshape(-1, BLOCK, q.shape[1])[best] @ q[row])).ravel(), k) - SLACK
            blocks = np.flatnonzero(limit >= least)
            still = rare[blocks] + limits[row, blocks][:, None] >= least
            if np.count_nonzero(still) * MOST_OPEN > len(self.norms):
                open_ones.append((row, rare))
            else:
                inside, place = np.nonzero(still)
                rows = blocks[inside] * BLOCK + place
                out[row] = self._finish(rows, rare.ravel()[rows] + self.often[rows] @ q[row], ids, w, rare, k)
        if open_ones:
            sums = q[[row for row, _ in open_ones]] @ self.often.T
            every, n = np.arange(len(self.norms)), len(self.norms)
            for (row, rare), dense in zip(open_ones, sums):
                out[row] = self._finish(every, rare.ravel()[:n] + dense[:n], *vectors[row], rare, k)
        return out

    def _finish(self, rows: np.ndarray, near: np.ndarray, ids: np.ndarray, w: np.ndarray, rare: np.ndarray, k: int):
        rows = rows[near >= max(_kth(near, k), 0) - SLACK]
        cosines = self._exact(rows, ids, w, rare)
        some = cosines > 0
        rows, cosines = rows[some], cosines[some]
        first = np.lexsort((rows, -np.round(cosines, 12)))[:k]
        return rows[first], cosines[first]

    def nearest(self, ids: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS) -> tuple[np.ndarray, np.ndarray]:
        return self.search([(ids, w)], k)[0]

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        """Log odds of the votes, each weighing as its squared cosine, so that far neighbours hardly count against the share of label 1."""
        weights = cosines * cosines
        one = float(weights[self.label[rows] == 1].sum()) + self.base
        zero = float(weights[self.label[rows] == 0].sum()) + 1 - self.base
        return math.log(one / zero)

    def _calibrate(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[float, float]:
        """Logistic regression of the label on the vote of an example's neighbours other than itself, with smoothed targets."""
        some = range(0, len(counts), max(1, len(counts) // 1500))
        parts = [some[at:at + TOGETHER] for at in range(0, len(some), TOGETHER)]
        x = np.array([self.vote(*found) for part in parts for found in self.search([self._unit(*counts[i]) for i in part], without=part)])
        y = np.array([float(self.label[i]) for i in some])
        if not len(y) or y.min() == y.max():
            return 1.0, 0.0
        n1, n0 = y.sum(), len(y) - y.sum()
        target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        design = np.stack([x, np.ones_like(x)], 1)
        beta = np.array([1.0, 0.0])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
            gradient = design.T @ (target - p) - 0.01 * (beta - [1.0, 0.0])
            beta = beta + np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2), gradient)
        return max(0.2, float(beta[0])), float(beta[1])

    def score(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, np.ndarray, np.ndarray]]:
        """Score, nearest examples and their cosines for each vector."""
        found = [x for at in range(0, len(vectors), TOGETHER) for x in self.search(vectors[at:at + TOGETHER])]
        return [
            (1 / (1 + math.exp(-np.clip(self.slope * self.vote(rows, cosines) + self.shift, -30, 30))) if len(rows) else float(self.silent),
             rows, cosines) for rows, cosines in found]


def _counted(text: str, known: dict[str, bytes], ids_of) -> tuple[np.ndarray, np.ndarray]:
    """The distinct term ids of a text and their counts; `ids_of` gives those of a word that is not in `known` yet, which keeps them as
    the bytes of an array, so that those of a text are joined without a number each."""
    words = words_of(text)
    try:
        found = b"".join(map(known.__getitem__, words))
    except KeyError:
        known.update((word, array("i", ids_of(word)).tobytes()) for word in set(words).difference(known))
        found = b"".join(map(known.__getitem__, words))
    ids, times = np.unique(np.frombuffer(found, np.int32), return_counts=True)
    return ids, times.astype(np.int32)


def _kth(values: np.ndarray, k: int) -> float:
    return float(np.partition(values, -k)[-k]) if len(values) >= k else -1.0


_HELD: dict[str, Examples] = {}


def _unpacked(key: str, data: bytes) -> Examples:
    """The examples of a task; a worker keeps the last ones for its next task."""
    if key not in _HELD:
        _HELD.clear()
        terms, state = pickle.loads(zlib.decompress(data))
        made = Examples.__new__(Examples)
        made.terms = {t: i for i, t in enumerate(terms.split("\n"))} if terms else {}
        sizes, rows, tf = (state.pop(k) for k in ("sizes", "rows", "tf"))
        made.__dict__.update(state)
        made._lists(sizes, rows, tf)
        _HELD[key] = made
    return _HELD[key]


def _certainty(n: np.ndarray, ones: np.ndarray, all_ones: int, everything: int) -> np.ndarray:
    """The scale of each term that is in `n` examples, `ones` of them with label 1."""
    g2 = np.zeros(len(n))
    for seen, share in ((ones, all_ones / max(1, everything)), (n - ones, 1 - all_ones / max(1, everything))):
        some = seen > 0
        g2[some] += 2 * seen[some] * np.log(seen[some] / (n[some] * share))
    g2 = np.maximum(g2, 0)
    return LEAST_WEIGHT + g2 / (g2 + 2 * math.log(max(2, len(n)) / CHANCE))


def _scorer(examples: Examples, held_fold: int, cut: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, bytes] = {}
        for batch in small(batches):
            scores, evidence = [], []
            vectors = [examples.vector_of(text or "", known) for text in batch.column("text").to_pylist()]
            for s, rows, cosines in examples.score(vectors):
                scores.append(s)
                evidence.append([
                    {"example": r, "cosine": c, "label": int(examples.label[r])} for r, c in zip(rows[:3].tolist(), cosines[:3].tolist())])
            if len(known) > 1 << 17:
                known.clear()
            score = np.array(scores, float)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "held_out": pa.array(batch.column("fold").to_numpy() == held_fold),
                "score": pa.array(score), "predicted": pa.array((score >= cut).astype(np.int32)),
                "neighbours": pa.array(evidence, pa.list_(pa.struct([("example", pa.int32()), ("cosine", pa.float64()), ("label", pa.int32())])))})
    return score


def toxicity(documents: DataFrame, labels: DataFrame, held_fold: int = 2, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted, neighbours for each row of `documents(doc_id, text)`.

    Examples are a bounded sample (`SAMPLE` rows by label, of texts up to 50,000 characters) of the rows of `labels(doc_id, toxic)`
    whose id has crc32 modulo 4 other than `held_fold`; a score uses the text alone. `neighbours` are the three nearest examples.
    Texts without any term of an example, null and empty ones too, get the smoothed share of label 1 among all examples, and so do all
    texts without labels. Null and repeated ids keep a row each (a null id counts as the empty
    text for the fold); an empty table gives an empty result; other columns are ignored; texts are scored whole.
    """
    sample = labelled_sample(documents, labels, "toxic", fold(F.col("doc_id"), 4) != held_fold, SAMPLE)
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text"), fold(F.col("doc_id"), 4).cast("int").alias("fold"))
    return rows.mapInArrow(_scorer(Examples(sample), held_fold, cut), RESULT)
