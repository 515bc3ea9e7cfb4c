"""Helpers shared by the operators: scratch tables, ordered buckets, skew-safe look-ups, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.llm.words import mix
from tagpulse.session import prepare, scratch_path, ship_package

#: Rows in an Arrow batch handed to Python; texts are long, so batches stay small.
BATCH_ROWS = 128
#: Largest number of ordered buckets; their bounds are literals in the plan.
MAX_BUCKETS = 8192
ROWS_PER_BUCKET = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def arrow_batches(spark: SparkSession) -> None:
    """Ready Python tasks: the package at hand, and few rows in each Arrow batch to bound memory."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, runs it once."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path  # noqa: SLF001
    return out


def discard(*frames: DataFrame) -> None:
    """Delete scratch tables that nothing reads any more."""
    for df in frames:
        jvm, spark = df.sparkSession._jvm, df.sparkSession  # noqa: SLF001
        path = jvm.org.apache.hadoop.fs.Path(df._scratch)  # noqa: SLF001
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


# --- ordered buckets ---------------------------------------------------------

def order_bounds(df: DataFrame, key: str, rows: int | None = None) -> list[int]:
    """Bounds of buckets of about ``ROWS_PER_BUCKET`` rows in key order, at most ``MAX_BUCKETS``.

    They come from one approximate-quantile aggregate over all rows and are
    literals from then on, so every plan and every retried task sees the same
    buckets.  Buckets differ a little in size; nothing depends on that."""
    rows = df.count() if rows is None else rows
    pieces = min(MAX_BUCKETS, rows // ROWS_PER_BUCKET)
    if pieces < 2:
        return []
    at = [i / pieces for i in range(1, pieces)]
    found = df.agg(F.percentile_approx(key, at, 20 * pieces)).first()[0]
    return sorted(set(found or []))


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``key`` (null: 0), found in two steps of about sqrt(n) each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    group = F.size(F.filter(heads, lambda b: b <= key))
    inner = F.element_at(F.array(*[F.array(*[F.lit(b) for b in g]) for g in groups]), F.greatest(group, F.lit(1)))
    return F.when(key.isNull() | (group == 0), F.lit(0)).otherwise(
        (group - 1) * step + F.size(F.filter(inner, lambda b: b <= key)))


# --- fixed-size counters -----------------------------------------------------

_COUNTER_SCHEMA = "block int, counts binary"
COUNTER_BLOCKS = 64


def counter_rows(counts: np.ndarray, kind: type = np.int64) -> Iterator[tuple[int, bytes]]:
    """A task's counters as compressed blocks."""
    import zlib
    for i, part in enumerate(np.array_split(counts, COUNTER_BLOCKS, axis=-1)):
        if part.any():
            yield i, zlib.compress(np.ascontiguousarray(part, kind).tobytes(), 1)


def sum_counters(blocks: DataFrame, shape: tuple[int, ...], kind: type = np.int64, wide: type | None = None,
                 finish: Callable[[np.ndarray], np.ndarray] = lambda part: part) -> np.ndarray:
    """Element-wise sum of the tasks' counters (of ``kind``), as ``wide`` numbers; unsigned kinds stop at their largest value.
    ``finish`` is applied to each block of the sum, before they are put together.

    Blocks of one number meet in one task, which adds them as they stream in;
    the sum has the fixed size ``shape``, however large the input."""
    parts = [p.shape for p in np.array_split(np.empty(shape, np.int8), COUNTER_BLOCKS, axis=-1)]
    wide = wide or kind

    def plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = a + b
        if np.issubdtype(wide, np.unsignedinteger):
            out[out < a] = np.iinfo(wide).max
        return out

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(zlib.decompress(blob.as_py()), kind).astype(wide)
                total[i] = plus(total[i], part) if i in total else part
        for i, part in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["block", "counts"])

    import zlib
    rows = (blocks.repartition(COUNTER_BLOCKS, "block").mapInArrow(add, _COUNTER_SCHEMA)).collect()
    found = {r["block"]: finish(np.frombuffer(zlib.decompress(bytes(r["counts"])), wide)) for r in rows}
    return np.concatenate([found[i].reshape(s) if i in found else finish(np.zeros(s, wide))
                           for i, s in enumerate(parts)], axis=-1)


#: Slots of a bitmap of ids.
ID_BITS = 23


def id_filter(ids: DataFrame) -> np.ndarray:
    """A fixed-size bitmap of ids: which documents a later scan may skip for certain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << ID_BITS, np.uint8)
        for batch in batches:
            counts[id_slot(batch.column(0).to_numpy())] = 1
        blocks = list(counter_rows(counts, np.uint8))
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())],
                                             ["block", "counts"])

    return sum_counters(ids.mapInArrow(run, "block int, counts binary"), (1 << ID_BITS,), np.uint8) > 0


def id_slot(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - ID_BITS)).astype(np.int64)


# --- look-ups ----------------------------------------------------------------

#: Keys that make up more than this share of the rows are looked up by broadcast; there are at most HEAVY of them.
HEAVY = 2000


def look_up(rows: DataFrame, found: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of many rows with a table that is unique on ``keys``; no key can make a task slow.

    ``weight`` counts the rows of each key.  Keys with more than ``total / HEAVY``
    rows number at most ``HEAVY``, so they are broadcast whatever the input;
    the others are joined by shuffle, where no key exceeds that share."""
    limit = max(1, total // HEAVY)
    heavy = found.where(F.col(weight) > limit).drop(weight)
    light = found.where(F.col(weight) <= limit).drop(weight)
    light_rows = rows.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(heavy), keys).unionByName(light_rows.join(light, keys))


# --- connected components ----------------------------------------------------

def components(edges: DataFrame, checkpoint: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """``(node, component)`` of an edge list ``(a, b)``: the smallest node reachable.

    Each round every node takes the smallest label among itself, its neighbours
    and its label's label, until nothing changes.  Joins are plain shuffles of
    two stored tables (splittable when a node has many neighbours) and their
    results are pre-aggregated; labels only fall, so a repeated task is harmless.
    """
    both = checkpoint(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
                      .where("a <> b").distinct(), "edges")
    stored = checkpoint(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                        .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        labels = stored.select("node", "label")
        offered = both.join(labels.withColumnRenamed("node", "a"), "a").select(F.col("b").alias("node"), "label")
        nearest = (offered.unionByName(labels).groupBy("node").agg(F.min("label").alias("label"))
                   .join(labels.withColumnRenamed("label", "old"), "node"))
        # A label is itself a node; following it once more halves the distance to the smallest.
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step = checkpoint(nearest.join(jump, "label", "left")
                          .select("node", F.least("label", "further").alias("label"), "old"), "labels")
        discard(stored)
        stored = step
        if step.where("label <> old").isEmpty():
            discard(both)
            return step.select("node", F.col("label").alias("component"))


#: One word of a text, as a Java and DuckDB pattern alike.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
