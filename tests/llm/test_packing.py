import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from bidloom.llm import packing
from bidloom.llm.vocabulary import ByteVocabulary
from tests.llm.common import awkward_rows, empty, frame, text_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def plain_fill(items, room):
    """One bin by the definition, over the list of all unpacked pieces; the bin and what is left."""
    items, bin_ = sorted(items), []
    while fitting := [x for x in items if x <= room]:
        bin_.append(fitting[-1])
        items.remove(fitting[-1])
        room -= fitting[-1]
    if bin_ and room:
        shortest = min(bin_)
        pairs = [(a + b, a, b) for i, a in enumerate(items) for b in items[:i] if shortest < a + b <= shortest + room]
        if pairs:
            _, a, b = max(pairs)
            bin_.remove(shortest)
            for x in (a, b):
                items.remove(x)
                bin_.append(x)
            items.append(shortest)
    return sorted(bin_, reverse=True), items


def plain_bins(counts, capacity, reserve):
    waiting = [x for x, n in counts.items() for _ in range(n) if x <= reserve]
    items, bins = [x for x, n in counts.items() for _ in range(n) if x > reserve], []
    while items:
        bin_, items = plain_fill(items, capacity)
        bins.append(bin_)
    for bin_ in sorted(bins, key=lambda b: capacity - sum(b)):
        more, waiting = plain_fill(waiting, capacity - sum(bin_))
        bin_ += more
    while waiting:
        bin_, waiting = plain_fill(waiting, capacity)
        bins.append(bin_)
    return sorted(sorted(b, reverse=True) for b in bins)


def test_plan_equals_bins_filled_one_by_one():
    rng = np.random.default_rng(5)
    for trial in range(150):
        capacity = int(rng.integers(5, 60))
        n = int(rng.integers(1, 50))
        sizes = rng.integers(1, capacity + 1, n) if trial % 2 else np.minimum(capacity, rng.geometric(3 / capacity, n))
        counts = {int(a): int(b) for a, b in zip(*np.unique(sizes, return_counts=True))}
        reserve = (0, capacity // 6, capacity // 3)[trial % 3]
        plan = packing.best_two_fit(counts, capacity, reserve)
        assert sorted([x for x, k in p.pieces for _ in range(k)] for p in plan for _ in range(p.times)) == plain_bins(counts, capacity, reserve)


def test_plan_size_does_not_follow_the_pieces():
    rng = random.Random(1)
    shares = {length: rng.randrange(1, 100) for length in range(1, 1025)}
    plans = [packing.fewest_bins({x: n * times for x, n in shares.items()}, 1024) for times in (1, 10**6)]
    small, large = (sum(p.times for p in plan) for plan in plans)
    assert len(plans[1]) < 5000 and large <= small * 10**6
    tokens = sum(x * n for x, n in shares.items())
    alone = sum(n for x, n in shares.items() if x > 512)  # no two of them share a sequence
    assert small <= 1.002 * max(alone, tokens / 1024) + 1
    with pytest.raises(ValueError):
        packing.best_two_fit({1025: 1}, 1024)


def test_ids_are_those_of_the_library():
    from tokenizers import Tokenizer

    library, ours = Tokenizer.from_file(VOCABULARY), ByteVocabulary(VOCABULARY)
    assert ours.ranks is not None
    rng = random.Random(2)
    texts = [text_of(rng, rng.randrange(60)) for _ in range(300)] + ["", " ", "<|endoftext|>", "a <|endoftext|>\n<|endoftext|> b", "x" * 5000]
    texts += ["".join(chr(rng.choice((rng.randrange(1, 0x500), rng.randrange(0xE000, 0x1F700)))) for _ in range(40)) for _ in range(500)]
    texts += ["a" + " " * 60_000 + "b", "\n\t" * 600_000]
    for text in texts:
        assert ours.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    library.encode_special_tokens = True
    for text in texts:
        assert ours.encode(text, specials=False).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_vocabulary_of_another_make_is_read_by_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    ours = ByteVocabulary(path)
    assert ours.ranks is None
    assert ours.encode("Some words").tolist() == Tokenizer.from_file(path).encode("Some words", add_special_tokens=False).ids


@pytest.mark.parametrize("capacity", [64, 1024])
def test_pieces_give_back_the_documents_and_fill_sequences_without_gaps(spark, capacity):
    rows = awkward_rows()
    found = packing.pack(frame(spark, rows), VOCABULARY, capacity).collect()
    words = ByteVocabulary(VOCABULARY)
    wanted = sorted((-1 if r[0] is None else r[0], tuple(words.encode(r[1] or "").tolist()) + (2,)) for r in rows)
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert len(r.ids) == 4 * r.length and 1 <= r.length <= capacity
    for held in by_sequence.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    tokens = sum(r.length for r in found)
    assert tokens == sum(len(ids) for _, ids in wanted)
    assert len(by_sequence) <= 1.02 * tokens / capacity + 2
    # documents again: ids that occur once are told apart by doc_id, the others by all their pieces
    single = {d for d in {w[0] for w in wanted} if sum(w[0] == d for w in wanted) == 1}
    built = {}
    for r in sorted((r for r in found if r.doc_id in single), key=lambda r: r.piece):
        ids = built.setdefault(r.doc_id, [])
        assert r.start == len(ids) and (r.length == capacity or r.piece == 0)
        ids += np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert {d: tuple(x) for d, x in built.items()} == {d: x for d, x in wanted if d in single}
    cut = sorted((d, n % capacity if k == 0 and n % capacity else capacity) for d, x in wanted for n in [len(x)] for k in range(-(-n // capacity)))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.length) for r in found) == cut


def test_carried_columns_and_whole_sequences(spark):
    rows = awkward_rows()[:60]
    documents = frame(spark, rows)
    carried = packing.pack(documents, VOCABULARY, 128, carry={"crc": F.crc32("ids")}).collect()
    packed = packing.pack(documents, VOCABULARY, 128)
    assert sorted((r.doc_id, r.piece, r.crc) for r in carried) == sorted((r.doc_id, r.piece, zlib.crc32(bytes(r.ids))) for r in packed.collect())
    whole = {r.sequence_id: (bytes(r.ids), r.doc_ids) for r in packing.sequences(packed).collect()}
    pieces = {}
    for r in packed.collect():
        pieces.setdefault(r.sequence_id, []).append((r.offset, bytes(r.ids), r.doc_id))
    assert sum(len(ids) for ids, _ in whole.values()) == sum(4 * r.length for r in packed.collect())
    assert set(whole) == set(pieces) and all(len(ids) <= 512 for ids, _ in whole.values())


def test_empty_tables_and_no_end(spark):
    assert packing.pack(empty(spark), VOCABULARY).collect() == []
    some = frame(spark, [(1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, "word", "en", "a", 4)])
    assert [(r.doc_id, r.length) for r in packing.pack(some, VOCABULARY, end=None).collect()] == [(3, 1)]
    assert sorted((r.doc_id, r.length) for r in packing.pack(some, VOCABULARY).collect()) == [(1, 1), (2, 1), (3, 2)]
