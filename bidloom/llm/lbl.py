"""A log-bilinear language model over word classes in numpy, trained by noise-contrastive estimation.

The next class w after the classes u (one back) and v (two back) has the score (c1*r_u + c2*r_v) . q_w + b_w, with one weight
vector for each position. As the score is a sum over positions, exp(score) is a product, and the normaliser of every pair of
context classes comes from one product of two matrices.
"""

from __future__ import annotations

import numpy as np

END, UNKNOWN, FIRST_WORD = 0, 1, 2
NAMES = ("r", "q", "b", "c")


def start(log_p: np.ndarray, width: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters that begin as the unigram model `log_p`. Contexts have one class more: before the text."""
    rng = np.random.default_rng(seed)
    n = len(log_p)
    return {
        "r": rng.normal(0, 0.1, (n + 1, width)).astype(np.float32), "q": rng.normal(0, 0.1, (n, width)).astype(np.float32),
        "b": log_p.astype(np.float32), "c": np.ones((2, width), np.float32)}


def contexts(classes: np.ndarray, offsets: np.ndarray, outside: int) -> tuple[np.ndarray, np.ndarray]:
    """The classes one and two back, not looking across the starts of documents."""
    one, two = np.empty_like(classes), np.empty_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    starts = offsets[:-1][np.diff(offsets) > 0]
    one[starts] = two[starts] = outside
    second = offsets[:-1][np.diff(offsets) > 1] + 1
    two[second] = outside
    return one, two


def _scatter(rows: np.ndarray, gradient: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(rows, kind="stable")
    sorted_rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
    out = np.zeros((n, gradient.shape[1]), np.float32)
    out[sorted_rows[first]] = np.add.reduceat(gradient[order], first, axis=0)
    return out


class Trainer:
    """AdaGrad over the NCE objective; a minibatch shares its noise classes, so that all scores are matrix products."""

    def __init__(self, parameters: dict[str, np.ndarray], log_noise: np.ndarray, noise: int = 32, rate: float = 0.05, seed: int = 11):
        self.p = {k: v.copy() for k, v in parameters.items()}
        self.g = {k: np.full_like(v, 1e-2) for k, v in parameters.items()}
        self.log_kn = (log_noise + np.log(noise)).astype(np.float32)
        self.cdf = np.cumsum(np.exp(log_noise.astype(np.float64)))
        self.noise, self.rate, self.rng, self.tokens = noise, rate, np.random.default_rng(seed), 0

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        p, n = self.p, len(word)
        r1, r2, q = p["r"][one], p["r"][two], p["q"][word]
        h = p["c"][0] * r1 + p["c"][1] * r2
        up = 1 - _sigmoid((h * q).sum(1) + p["b"][word] - self.log_kn[word])
        drawn = np.minimum(np.searchsorted(self.cdf, self.rng.random(self.noise) * self.cdf[-1]), len(self.cdf) - 1)
        q_noise = p["q"][drawn]
        down = -_sigmoid(h @ q_noise.T + p["b"][drawn] - self.log_kn[drawn])
        dh = up[:, None] * q + down @ q_noise
        dq = _scatter(word, up[:, None] * h, len(p["b"]))
        np.add.at(dq, drawn, down.T @ h)
        db = np.bincount(word, up, len(p["b"])) + np.bincount(drawn, down.sum(0), len(p["b"]))
        dr = _scatter(np.concatenate((one, two)), np.concatenate((dh * p["c"][0], dh * p["c"][1])), len(p["r"]))
        gradient = {"r": dr, "q": dq, "b": db.astype(np.float32), "c": np.stack([(dh * r1).sum(0), (dh * r2).sum(0)])}
        for k in NAMES:
            g = gradient[k] / n
            self.g[k] += g * g
            p[k] += self.rate * g / np.sqrt(self.g[k])
        self.tokens += n

    def fit(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, size: int = 16384) -> None:
        for at in range(0, len(word), size):
            self.step(one[at:at + size], two[at:at + size], word[at:at + size])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Tables:
    """log10 probabilities by lookup: scores for each position and the normaliser for each pair of contexts."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.s1 = (p["c"][0] * p["r"]) @ p["q"].T
        self.s2 = (p["c"][1] * p["r"]) @ p["q"].T + p["b"]
        top1, top2 = self.s1.max(1, keepdims=True), self.s2.max(1, keepdims=True)
        z = np.exp(self.s1 - top1) @ np.exp(self.s2 - top2).T
        self.log_z = np.log(z) + top1 + top2.T

    def log10(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
        return (self.s1[one, word] + self.s2[two, word] - self.log_z[one, two]).astype(np.float64) / np.log(10)


def to_bytes(p: dict[str, np.ndarray], scale: float = 1.0) -> bytes:
    return np.concatenate([(p[k].astype(np.float64) * scale).ravel() for k in NAMES]).astype(np.float64).tobytes()


def from_vector(vector: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k in NAMES:
        out[k] = vector[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out
