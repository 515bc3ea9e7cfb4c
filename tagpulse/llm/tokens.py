"""Runs of bytes in Arrow text columns, packed integers, and batches of a bounded size.

Batches are gathered to about ``size`` bytes of text, whatever the session's batch size is; one longer text is
a batch of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

_U = np.uint64
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs that run inside; afterwards it is as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def batch_bytes(spark: SparkSession, size: int):  # noqa: ANN201
    """Arrow batches of at most ``size`` bytes for the jobs that run inside."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def batch_rows(spark: SparkSession, rows: int):  # noqa: ANN201
    """Arrow batches of at most ``rows`` rows for the jobs that run inside."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def gathered(batches: Iterator[pa.RecordBatch], size: int, text: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most about ``size`` bytes of column ``text``."""
    held, held_bytes = [], 0
    for batch in batches:
        at, offsets = 0, _offsets(batch.column(text))
        while at < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[at] + size - held_bytes, "right")) - 1
            if end <= at and held:
                yield _joined(held)
                held, held_bytes = [], 0
                continue
            end = max(end, at + 1)
            held.append(batch.slice(at, end - at))
            held_bytes += int(offsets[end] - offsets[at])
            at = end
    if held:
        yield _joined(held)


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty text) and where each row's begin, the end included."""
    if column.null_count:
        column = column.fill_null("")
    offsets = _offsets(column)
    buffer = column.buffers()[2] if len(column) else None
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def runs(inside: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes in each row, and each row's first run (the end included)."""
    before = np.zeros(len(inside) + 1, bool)
    before[1:] = inside
    before[rows] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(inside) + 1, bool)
    after[:-1] = inside
    after[rows] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, rows)


def pack(values: np.ndarray) -> bytes:
    """Integers as the narrowest unsigned bytes that hold the largest, byte planes together, compressed."""
    top = int(values.max()) if len(values) else 0
    width = max(1, (top.bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    raw = np.ascontiguousarray(planes).tobytes()
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> np.ndarray:
    width, n = blob[0], int.from_bytes(blob[1:9], "little")
    raw = pa.decompress(blob[9:], decompressed_size=width * n, codec="zstd", asbytes=True)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8").astype(_U, copy=False)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned integers, as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=_U)


def bucket_cuts(values: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of ``buckets`` equal ranges of the 64-bit numbers begins among ascending ``values`` (the end included)."""
    bounds = np.array([-(-(i << 64) // buckets) for i in range(1, buckets)], dtype=object).astype(_U)
    return np.concatenate([[0], np.searchsorted(values, bounds), [len(values)]]).astype(np.int64)
