import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from bidloom.llm import lbl, lm_scores, token_counts

from .common import awkward_rows, empty, frame

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts_equal_the_library(spark):
    rows = awkward_rows()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = sorted(
        (-1 if r[0] is None else r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False))) for r in rows)
    got = token_counts.token_counts(frame(spark, rows), VOCABULARY).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)
    assert token_counts.token_counts(empty(spark), VOCABULARY).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_pre_tokens_of_random_texts(seed):
    """Chunks between blanks give the same pieces as the whole text."""
    import random

    rng = random.Random(seed)
    alphabet = [" ", " ", " ", "\n", "\t", " ", "\x1c", "a", "B", "é", "7", "'", "s", "!", "東", "\x85", " "]
    splitter = token_counts.Splitter(["<|endoftext|>"])
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 14)))
        splitter.clear()
        counts = splitter.counts(text)
        names = list(splitter.ids)
        total = sum(n * len(tokenizer.encode(names[k], add_special_tokens=False)) for k, n in counts.items())
        assert total == len(tokenizer.encode(text, add_special_tokens=False)), repr(text)


def _words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def _held(doc_id, modulus, fold):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % modulus == fold


def test_base_scores_equal_brute_force_and_model_is_normalised(spark):
    rows = awkward_rows()
    counts = Counter()
    for doc_id, text, *_ in rows:
        if not _held(doc_id, 7, 2):
            counts.update([*_words(text), None])
    tokens, types = sum(counts.values()), len(counts)
    want = []
    for doc_id, text, *_ in rows:
        seq = [*_words(text), None]
        base = sum(math.log10((counts[w] + 1) / (tokens + 1 * (types + 1))) for w in seq)
        want.append((-1 if doc_id is None else doc_id, _held(doc_id, 7, 2), len(seq), sum(counts[w] > 0 for w in seq), tokens, round(base, 6)))
    got = lm_scores.lm_scores(frame(spark, rows), classes=20, width=8).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm_scores.lm_scores(empty(spark)).collect() == []


def test_without_training_documents(spark):
    held = next(i for i in range(100) if _held(i, 7, 2))
    r = lm_scores.lm_scores(frame(spark, [(held, "a b", None, None, None)])).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)


def test_model_learns_order_and_sums_to_one():
    rng = np.random.default_rng(0)
    n = 8
    following = np.array([1, 2, 3, 4, 5, 6, 7, 0])
    seq = [0]
    for _ in range(60_000):
        seq.append(int(following[seq[-1]]) if rng.random() < 0.8 else int(rng.integers(n)))
    words, offsets = np.array(seq), np.array([0, len(seq)])
    log_p = np.log(np.bincount(words, minlength=n) / len(words))
    one, two = lbl.contexts(words, offsets, n)
    trainer = lbl.Trainer(lbl.start(log_p, 8), log_p, rate=0.1)
    for _ in range(12):
        trainer.fit(one, two, words, 1024)
    tables = lbl.Tables(trainer.p)
    for a, b in [(0, 3), (n, n), (5, n), (2, 2)]:
        total = sum(10 ** tables.log10(np.array([a]), np.array([b]), np.array([w]))[0] for w in range(n))
        assert abs(total - 1) < 1e-4
    assert tables.log10(one, two, words).mean() > log_p[words].mean() / math.log(10) + 0.1


def test_contexts_stop_at_documents():
    one, two = lbl.contexts(np.array([1, 2, 3, 4, 5]), np.array([0, 1, 1, 3, 5]), 9)
    assert one.tolist() == [9, 9, 2, 9, 4] and two.tolist() == [9, 9, 9, 9, 9]


def test_blocks_exceed_their_bytes_by_one_text_at_most():
    import pyarrow as pa

    from bidloom.llm.blocks import ROW_BYTES, grouped_texts

    rng = random.Random(1)
    for sizes in ([300_000] * 200, [rng.choice([0, 10, 5000, 900_000]) for _ in range(1500)], [5] * 3000, [], [2_000_000] * 3):
        texts = ["x" * n if n != 10 else None for n in sizes]
        batches = [pa.RecordBatch.from_pydict({"text": pa.array(texts[k:k + 700], pa.string())}) for k in range(0, len(texts), 700)]
        got, block = [], []
        for part, last in grouped_texts(iter(batches), "text", 1 << 20):
            block += part.column("text").to_pylist()
            if last:
                bytes_of = [len(t or "") + ROW_BYTES for t in block]
                assert sum(bytes_of[:-1]) < 1 << 20
                got, block = got + block, []
        assert got == texts and not block
