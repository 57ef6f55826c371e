"""Hamming neighbours inside buckets of 64-bit fingerprints, on vertical bit planes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Planes between two looks at which blocks can be abandoned.
LOOK = 8
#: (row, block of 64 rows) pairs compared at a time.
ITEMS = 1 << 16


def _planes(fps: np.ndarray, word: np.ndarray, lane: np.ndarray, n_words: int) -> np.ndarray:
    """planes[j, w]: bit j of the up to 64 fingerprints of block w."""
    planes = np.zeros((64, n_words), np.uint64)
    first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    for j in range(64):
        planes[j] = np.bitwise_or.reduceat(((fps >> np.uint64(j)) & np.uint64(1)) << lane, first)
    return planes


def near_lanes(fps: np.ndarray, planes: np.ndarray, row: np.ndarray, word: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of items with a hit and the lanes within `radius`. Counters are bitwise: `radius` + 1 one-hot levels would be
    too wide, so distances are kept in two's powers by carry-save addition, and `over` stays set once a counter passes 7."""
    live = np.arange(len(row))
    one = np.zeros(len(row), np.uint64)
    two, four, over = one.copy(), one.copy(), one.copy()
    for j in range(64):
        bit = (fps[row[live]] >> np.uint64(j)) & np.uint64(1)
        carry = planes[j][word[live]] ^ (np.uint64(0) - bit)
        one, carry = one ^ carry, one & carry
        two, carry = two ^ carry, two & carry
        four, carry = four ^ carry, four & carry
        over |= carry
        if j % LOOK == LOOK - 1:
            far = _beyond(one, two, four, over, radius)
            keep = far != ~np.uint64(0)
            if not keep.all():
                live, one, two, four, over = live[keep], one[keep], two[keep], four[keep], over[keep]
    return live, ~_beyond(one, two, four, over, radius)


def _beyond(one: np.ndarray, two: np.ndarray, four: np.ndarray, over: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose counter is above `radius` (0 to 7), comparing from the highest bit down."""
    above, equal = over.copy(), ~over
    for counter, k in ((four, 2), (two, 1), (one, 0)):
        if radius >> k & 1:
            equal = equal & counter
        else:
            above |= equal & counter
            equal = equal & ~counter
    return above


def _links(fps: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fingerprint linked inside its bucket: itself and the first member of its part of the bucket."""
    n = len(fps)
    sizes = np.diff(np.append(starts, n))
    inside = np.arange(n) - np.repeat(starts, sizes)
    blocks = (sizes + 63) // 64
    first_block = np.concatenate(([0], np.cumsum(blocks)[:-1]))
    word = np.repeat(first_block, sizes) + inside // 64
    lane = (inside % 64).astype(np.uint64)
    planes = _planes(fps, word, lane, int(blocks.sum()))
    members = np.zeros(planes.shape[1], np.uint64)
    np.bitwise_or.at(members, word, np.uint64(1) << lane)
    base = np.repeat(starts, blocks) + 64 * (np.arange(len(members)) - np.repeat(first_block, blocks))  # row of lane 0
    reach = np.repeat(first_block + blocks, sizes) - word  # own block and those after it
    ends = np.cumsum(reach)
    label = np.arange(n)
    left, right = [], []
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + ITEMS, "right")))
        row = np.repeat(np.arange(at, stop), reach[at:stop])
        step = np.arange(len(row)) - np.repeat(np.cumsum(reach[at:stop]) - reach[at:stop], reach[at:stop])
        block = word[row] + step
        item, lanes = near_lanes(fps, planes, row, block, radius)
        lanes &= members[block[item]]
        item, lanes = item[lanes != 0], lanes[lanes != 0]
        bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, k = np.nonzero(bits)
        i, j = row[item[which]], base[block[item[which]]] + k
        keep = i < j
        left.append(i[keep].astype(np.int32)), right.append(j[keep].astype(np.int32))
        if sum(map(len, left)) > 1 << 22 or stop == n:
            i, j = np.concatenate(left), np.concatenate(right)
            _settle(label, i, j)
            left, right = [], []
            if stop < n:  # the parts found so far stand for their pairs
                moved = np.flatnonzero(label != np.arange(n))
                left, right = [label[moved].astype(np.int32)], [moved.astype(np.int32)]
        at = stop
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Lowest label along pairs, with pointer jumping, until nothing changes."""
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped
        if (label == before).all():
            return


def linker(radius: int):
    """Rows (mask, key, fp) come sorted by mask and key; a bucket is a run of equal mask and key."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy() for k in ("mask", "key", "fp")]))
            if sum(h.shape[1] for h in held) >= 1 << 16:
                rows = np.concatenate(held, axis=1)
                last = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(0))
                cut = last[-1] + 1 if len(last) else 0
                held = [rows[:, cut:]]
                if cut:
                    yield _out(rows[:, :cut], radius)
        if held and sum(h.shape[1] for h in held):
            yield _out(np.concatenate(held, axis=1), radius)
    return link


def _out(rows: np.ndarray, radius: int) -> pa.RecordBatch:
    change = (rows[:2, 1:] != rows[:2, :-1]).any(0)
    starts = np.flatnonzero(np.concatenate(([True], change)))
    a, b = _links(rows[2].view(np.uint64), starts, radius)
    return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})
