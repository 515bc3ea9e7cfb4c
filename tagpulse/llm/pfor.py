"""Token ids in patched frame-of-reference blocks.

``encode`` cuts a run of ids into blocks, subtracts each block's minimum and packs the
differences, bit plane by bit plane, at the width that holds a given percentile of them.
Larger differences go whole into the block's exception list, which is patched over the
unpacked values.  An index holds where each block and each list starts, so
``decode_block`` reads one block alone.

A written table is a folder of segments in ascending document order: rows
``(bucket, segment, start, doc_ids, lengths, payload)`` in Parquet, where ``payload`` is one
encoded run of about ``SEGMENT_IDS`` ids and never cuts a document.  Spark reads and
writes it, so any store will do.  Documents are dealt to ordered buckets by quantiles of
their ids and sorted there; the starts need only the sums of the buckets.

``PieceEncoder`` gives a text's ids as the tokenizers library does: a byte-level
pre-tokenizer always cuts before a run of white space, and between a letter or digit and
punctuation, so the library encodes each distinct piece between such cuts once and the
pieces' ids are put together.  Texts with
white space beyond ASCII, control separators or a special token's string are
encoded whole.

Defined results: a null or empty text is the end id alone; a null id comes first;
rows with the same id are ordered by text and all kept; an empty table gives an
empty file and result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.common import arrow_batches, bucket_of, cores, order_bounds
from tagpulse.llm.words import Chunk, chunks, split_pieces

BLOCK = 256
PERCENTILE = 0.98
SEGMENT_IDS = 1 << 20
END_ID = 2
#: Bytes of text whose pieces are looked up together; more share more.
CODED_AT_ONCE = 1 << 20
MAGIC = b"PFB1"
_HEAD = struct.Struct("<4sIQII")
SEGMENT_SCHEMA = "bucket int, segment int, start bigint, doc_ids array<bigint>, lengths array<bigint>, payload binary"


# --- the block format --------------------------------------------------------

def encode(values: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """Bytes of a run of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, np.uint32)
    n = -(-len(values) // block)
    if not n:
        return _HEAD.pack(MAGIC, block, 0, 0, 0)
    grid = np.full(n * block, values[-1], np.uint32)
    grid[:len(values)] = values
    grid = grid.reshape(n, block)
    low = grid.min(axis=1)
    grid = grid - low[:, None]
    at = min(block - 1, int(percentile * block))
    # frexp's exponent of an integer is its number of bits.
    width = np.frexp(np.partition(grid, at, axis=1)[:, at].astype(np.float64))[1].astype(np.uint8)
    row, col = np.nonzero(grid.astype(np.uint64) >> width[:, None].astype(np.uint64))
    lists = np.bincount(row, minlength=n)
    stride = block // 8
    starts = np.concatenate([[0], np.cumsum(width.astype(np.int64) * stride)])
    packed = np.zeros(starts[-1], np.uint8)
    for w in np.unique(width[width > 0]).tolist():
        rows = np.flatnonzero(width == w)
        part = grid[rows]
        planes = np.stack([np.packbits((part >> np.uint32(k)).astype(np.uint8) & 1, axis=1) for k in range(w)], axis=1)
        packed[(starts[rows][:, None] + np.arange(w * stride)).ravel()] = planes.reshape(-1)
    return b"".join([
        _HEAD.pack(MAGIC, block, len(values), n, len(row)), low.astype("<u4").tobytes(), width.tobytes(),
        starts.astype("<u8").tobytes(), np.concatenate([[0], np.cumsum(lists)]).astype("<u8").tobytes(),
        col.astype("<u2").tobytes(), grid[row, col].astype("<u4").tobytes(), packed.tobytes()])


class Reader:
    """Decodes an encoded run, whole or by block."""

    def __init__(self, blob: bytes) -> None:
        magic, self.block, self.count, n, exceptions = _HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a block file")
        at = _HEAD.size

        def take(kind: str, size: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, size, at)
            at += out.nbytes
            return out

        self.low, self.width = take("<u4", n), take("u1", n)
        index = n + 1 if n else 0
        self.starts, self.lists = take("<u8", index).astype(np.int64), take("<u8", index).astype(np.int64)
        self.where, self.patches = take("<u2", exceptions), take("<u4", exceptions)
        self.packed = np.frombuffer(blob, np.uint8, offset=at)

    def __len__(self) -> int:
        return len(self.low)

    def _unpack(self, rows: np.ndarray, width: int) -> np.ndarray:
        stride = self.block // 8
        planes = self.packed[(self.starts[rows][:, None] + np.arange(width * stride)).ravel()].reshape(len(rows), width, stride)
        out = np.zeros((len(rows), self.block), np.uint32)
        for k in range(width):
            out |= np.unpackbits(planes[:, k], axis=1).astype(np.uint32) << np.uint32(k)
        return out

    def decode_block(self, i: int) -> np.ndarray:
        out = self._unpack(np.array([i]), int(self.width[i]))[0]
        own = slice(self.lists[i], self.lists[i + 1])
        out[self.where[own]] = self.patches[own]
        return (out + self.low[i])[:self.count - i * self.block]

    def decode(self) -> np.ndarray:
        out = np.zeros((len(self), self.block), np.uint32)
        for w in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == w)
            out[rows] = self._unpack(rows, w)
        out[np.repeat(np.arange(len(self)), np.diff(self.lists)), self.where] = self.patches
        return (out + self.low[:, None]).reshape(-1)[:self.count]


# --- tokens ------------------------------------------------------------------

# UTF-8 of white space beyond ASCII and of control separators.
_ODD_SPACE = [b"\x1c", b"\x1d", b"\x1e", b"\x1f", "\x85".encode(), "\xa0".encode(), " ".encode(),
              *[chr(c).encode() for c in range(0x2000, 0x200B)],
              " ".encode(), " ".encode(), " ".encode(), " ".encode(), "　".encode()]
_LONE_WORD = re.compile(r" ?[A-Za-z]+").fullmatch


class PieceEncoder:
    """A byte-level BPE tokenizer with a memory of pieces, at most ``limit`` of them."""

    def __init__(self, path: str, limit: int = 1 << 21) -> None:
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # each piece is asked for once
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.first = np.zeros(256, bool)
        self.first[[s[0] for s in (*_ODD_SPACE, *self.special) if s]] = True
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.at = np.empty(0, np.int64)
        self.length = np.empty(0, np.int32)
        self.ids = np.empty(0, np.uint32)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """The library's ids; a lone word is a single pre-token, for which its model is asked directly."""
        out: list[list[int] | None] = [
            [t.id for t in self.model.tokenize("\u0120" + x[1:] if x[0] == " " else x)] if _LONE_WORD(x) else None for x in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = e.ids
        return out

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        ids = self._ids(texts)
        length = np.fromiter(map(len, ids), np.int32, len(ids))
        flat = np.fromiter((x for i in ids for x in i), np.uint32, int(length.sum()))
        at = len(self.ids) + np.cumsum(length, dtype=np.int64) - length
        put = np.searchsorted(self.known, hashes)
        self.known, self.at, self.length = np.insert(self.known, put, hashes), np.insert(self.at, put, at), np.insert(self.length, put, length)
        self.ids = np.concatenate([self.ids, flat])

    def odd_rows(self, chunk: Chunk) -> set[int]:
        found = set()
        text = None
        for i in np.flatnonzero(self.first[chunk.data]).tolist():
            text = text or chunk.data.tobytes()
            if any(text.startswith(s, i) for s in (*_ODD_SPACE, *self.special)):
                found.add(int(np.searchsorted(chunk.offsets, i, "right")) - 1)
        return found

    def encode(self, chunk: Chunk, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the chunk's rows, ``end`` after each, and the rows' lengths."""
        pieces = split_pieces(chunk)
        distinct, sample, which = np.unique(pieces.hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.limit:
            self._forget()
        spot = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != distinct[inside]
        if new.any():
            self._learn(distinct[new], [chunk.text(a, b).decode() for a, b in
                                        zip(pieces.starts[sample[new]].tolist(), pieces.ends[sample[new]].tolist(), strict=True)])
            spot = np.searchsorted(self.known, distinct)
        spot = spot[which]
        length = self.length[spot].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(length)])
        flat = self.ids[np.repeat(self.at[spot] - upto[:-1], length) + np.arange(upto[-1])]
        sizes = np.diff(upto[pieces.first])
        odd = self.odd_rows(chunk)
        if odd:
            rows = np.split(flat, upto[pieces.first][1:-1])
            texts = {r: chunk.text(chunk.offsets[r], chunk.offsets[r + 1]).decode() for r in odd}
            for r, ids in zip(texts, self._ids(list(texts.values())), strict=True):
                rows[r] = np.array(ids, np.uint32)
            flat, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
        out = np.full(len(flat) + len(sizes), end, np.uint32)
        out[np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes)] = flat
        return out, sizes + 1


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker; its memory of pieces outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# --- tables ------------------------------------------------------------------

def write_ids(docs: DataFrame, path: str, tokenizer: str, end: int = END_ID, key: str = "doc_id", text: str = "text",
              segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every text and write the ids, in ascending order of ``key``, to the folder ``path``."""
    spark = docs.sparkSession
    arrow_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    bounds = order_bounds(docs, key)
    rows = docs.select(bucket_of(F.col(key), bounds).alias("bucket"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(len(bounds) + 1, cores(spark)))
    ordered = rows.repartition(partitions, "bucket").sortWithinPartitions("bucket", "doc_id", "text")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)
        state = {"bucket": None, "segment": 0, "start": 0}
        docs_, lengths, ids, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if docs_:
                payload = encode(np.concatenate(ids))
                yield pa.RecordBatch.from_arrays([
                    pa.array([state["bucket"]], pa.int32()), pa.array([state["segment"]], pa.int32()), pa.array([state["start"]], pa.int64()),
                    pa.array([docs_], pa.list_(pa.int64())), pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([payload], pa.binary())], ["bucket", "segment", "start", "doc_ids", "lengths", "payload"])
                state["segment"] += 1
                state["start"] += held
                for x in (docs_, lengths, ids):
                    x.clear()
                held = 0

        for batch in batches:
            buckets, keys = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            # Chunks that end where a bucket ends.
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(buckets)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if buckets[a] != state["bucket"]:
                    yield from flush()
                    state.update(bucket=int(buckets[a]), segment=0, start=0)
                for chunk in chunks(batch.column(2).slice(a, b - a), CODED_AT_ONCE):
                    flat, sizes = code.encode(chunk, end)
                    docs_.extend(keys[a + chunk.lo:a + chunk.hi])
                    lengths.extend(sizes.tolist())
                    ids.append(flat)
                    held += len(flat)
                    if held >= segment_ids:
                        yield from flush()
        yield from flush()

    ordered.mapInArrow(segments, SEGMENT_SCHEMA).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a written table: ``doc_id, start, n_tokens, ids`` (ids as little-endian unsigned 32-bit bytes)."""
    return _read(spark, path, "ids binary", lambda ids: ids.astype("<u4").tobytes(), pa.binary())


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of a written table, from its decoded blocks."""
    return _read(spark, path, "ids_crc32 bigint", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())


def _read(spark: SparkSession, path: str, column: str, made, kind: pa.DataType) -> DataFrame:  # noqa: ANN001
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    # One row for each bucket, a fixed number at most, is summed over all; a segment knows its start in its bucket.
    n_ids = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = segments.groupBy("bucket").agg(F.sum(n_ids).alias("n")).select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("bucket_start"))
    placed = segments.join(F.broadcast(buckets), "bucket").select(
        (F.col("bucket_start") + F.col("start")).alias("start"), "doc_ids", "lengths", "payload")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                ids = np.split(Reader(row["payload"]).decode(), ends[:-1])
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - lengths, pa.int64()), pa.array(lengths),
                    pa.array([made(x) for x in ids], kind)], ["doc_id", "start", "n_tokens", column.split()[0]])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    return placed.mapInArrow(decode, f"doc_id bigint, start bigint, n_tokens bigint, {column}")
