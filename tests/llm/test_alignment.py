import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers

from bidloom.llm import alignment
from bidloom.llm.alignment import CSR, Aligner, align, product
from tests.llm.common import awkward_rows, empty, frame, text_of

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_rows(rows):
    """The contract, token by token, with the two libraries."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a_of, b_of = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_of.encode_special_tokens = True
    letters = alignment.byte_vocabulary(A).bytes_of
    found, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        a = a_of.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_of.encode(text) if text else []
        pieces = [b_of.id_to_piece(x) for x in b]
        raw_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p[:3] == "<0x" else p.replace("▁", " ").encode() for p in pieces]
        raw_a = [letters[x] for x in a]
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            a, b, raw_a, raw_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in common]
        counts.update(links)
        groups, before = [], 0
        for e in common:
            groups.append(",".join(str(x) for x, y in zip(a, ends_a) if before < y <= e) + "|" + ",".join(str(x) for x, y in zip(b, ends_b) if before < y <= e))
            before = e
        found.append((doc_id, len(a), len(b), len(common), links, ";".join(groups)))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(d, n_a, n_b, n, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), groups)
            for d, n_a, n_b, n, links, groups in found]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def short_rows():
    rng = random.Random(11)
    rows = [r for r in awkward_rows() if len(r[1] or "") < 5000]
    rows += [(900 + i, "".join(chr(rng.choice((rng.randrange(1, 0x500), rng.randrange(0x2000, 0x9000)))) for _ in range(30)), "en", "a", 1) for i in range(60)]
    return rows + [(990, "a▁b", "en", "a", 3), (991, "<s> </s><unk> <|endoftext|> <0x41>", "en", "a", 3), (992, "\x00\x01", "en", "a", 2)]


def test_rows_equal_the_plain_alignment(spark):
    rows = short_rows()
    found = alignment.alignment(frame(spark, rows), A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    assert order(map(tuple, found.collect())) == order(plain_rows([r[:2] for r in rows]))


def test_counts_meet_over_blocks_and_renderings(spark, monkeypatch):
    rows = short_rows()[:80]
    documents = frame(spark, rows, 7)  # seven tasks, so seven blocks at least
    digest = alignment.alignment(documents, A, B, render=lambda g: hashlib.sha256(g.encode()).hexdigest())
    plain = plain_rows([r[:2] for r in rows])
    assert order(map(tuple, digest.collect())) == order((*r[:7], r[7] and hashlib.sha256(r[7].encode()).hexdigest()) for r in plain)


def test_long_texts_and_empty_tables(spark):
    rng = random.Random(4)
    long = [(1, text_of(rng, 40_000), "en", "a", 1), (2, "x" * 300_000, "en", "a", 1), (3, " " * 70_000, "en", "a", 1), (4, None, None, None, None)]
    found = {r.doc_id: r for r in alignment.alignment(frame(spark, long), A, B).collect()}
    aligner = Aligner(A, B)
    for doc_id, text, *_ in long[:3]:
        a, b = aligner.tokens(text, aligner.pieces.encode(text))
        assert (found[doc_id].n_a, found[doc_id].n_b) == (len(a), len(b))
        groups = found[doc_id].groups.split(";") if found[doc_id].groups else []
        assert len(groups) == found[doc_id].n_groups == found[doc_id].n_links
        assert [int(x) for g in groups for x in g.split("|")[0].split(",")] == a.tolist()
        assert [int(x) for g in groups for x in g.split("|")[1].split(",")] == b.tolist()
    assert tuple(found[4]) == (4, 0, 0, 0, 0, 0, 0, "")
    assert alignment.alignment(empty(spark), A, B).collect() == []


def test_products_equal_dense_ones_in_blocks_of_any_size():
    rng = np.random.default_rng(3)
    def sparse(dense):
        rows, columns = np.nonzero(dense)
        return CSR(np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=len(dense))))), columns, dense[rows, columns], dense.shape[1])
    for most in (1, 7, 1 << 20):
        x, y = rng.integers(0, 3, (9, 12)) * (rng.random((9, 12)) < 0.4), rng.integers(0, 3, (12, 5)) * (rng.random((12, 5)) < 0.4)
        made, wanted = np.zeros((9, 5), int), np.zeros((9, 5), int)
        for r, c, v in product(sparse(x), sparse(y), most):
            made[r, c] = v
        wanted = x @ y
        assert (made == wanted).all()
        t = sparse(x).transposed()
        assert (t.indptr == sparse(x.T).indptr).all() and (t.indices == sparse(x.T).indices).all() and (t.data == sparse(x.T).data).all()


def test_overlap_and_group_links_of_a_small_case():
    # bytes: A = [0-3) [3-4) [4-6), B = [0-1) [1-4) [4-5) [5-6)
    found = align(np.array([10, 11, 12]), np.array([20, 21, 22, 23]), np.array([3, 1, 2]), np.array([1, 3, 1, 1]))
    assert found.cuts.tolist() == [4, 6] and [x.tolist() for x in found.links] == [[1, 2], [1, 3]]
    overlaps = [x for part in found.overlap_links() for x in zip(*map(np.ndarray.tolist, part))]
    assert overlaps == [(0, 0, 1), (0, 1, 2), (1, 1, 1), (2, 2, 1), (2, 3, 1)]
    groups = [x for part in found.group_links() for x in zip(*map(np.ndarray.tolist, part))]
    assert groups == [(0, 0, 1), (0, 1, 1), (1, 0, 1), (1, 1, 1), (2, 2, 1), (2, 3, 1)]
