"""Blocks: some tens of MB of documents that share one dictionary of their distinct strings.

A corpus has far more (document, word) pairs than (block, word) pairs, so what has to meet across the cluster is one row for
each distinct string of a block. Documents themselves stay in compressed payloads of local ids until the answers come back.
A block ends with the text that brings it to its bytes, so it exceeds them by less than that one text, and no task ever gathers more.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, functions as F

#: Bytes of text after which a block is closed.
BLOCK_BYTES = 48 << 20
#: What a row counts beside its text.
ROW_BYTES = 8

_OPTIONS = pa.ipc.IpcWriteOptions(compression="zstd")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def local_ids() -> defaultdict:
    """A dict that numbers its keys in order of first appearance."""
    ids: defaultdict = defaultdict()
    ids.default_factory = ids.__len__
    return ids


def pack(columns: dict[str, pa.Array]) -> bytes:
    batch = pa.RecordBatch.from_pydict(columns)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=_OPTIONS) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(payload: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(payload) as reader:
        return reader.read_next_batch()


def list_array(parts: list[np.ndarray], kind: np.dtype) -> pa.Array:
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    values = np.concatenate(parts).astype(kind, copy=False) if parts else np.empty(0, kind)
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(values))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    offsets = column.offsets.to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each slice; empty slices give 0."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def block_numbers() -> Iterator[int]:
    """Ids for the blocks of this task. They are unique in a written table, as only one attempt of a task is committed."""
    first = TaskContext.get().partitionId() << 24
    yield from range(first, first + (1 << 24))


def small(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    pa.default_memory_pool().release_unused()  # workers are used again; what one task needed should not stay with them


def grouped_texts(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Slices of at most 500 rows, and whether the block ends with it. A block ends with the row that brings it to `most` bytes."""
    size, waiting = 0, None
    for part in small(batches):
        ends = np.cumsum(pc.fill_null(pc.binary_length(part.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + ROW_BYTES)
        start = 0
        while start < part.num_rows:
            if waiting is not None:
                yield waiting, size >= most
                size = 0 if size >= most else size
            before = int(ends[start - 1]) if start else 0
            stop = min(part.num_rows, int(np.searchsorted(ends, before + most - size)) + 1)
            waiting, size, start = part.slice(start, stop - start), size + int(ends[stop - 1]) - before, stop
    if waiting is not None:
        yield waiting, True
