"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector; its
hash is the signed axis nearest to it.  ``hashes`` of them name a bucket of a table, and every vector
lies in one bucket of each of ``TABLES`` tables.  A query probes, in every table, the ``PROBES[hashes - 1] ** hashes``
buckets whose axes fit it best, and is compared exactly, in double precision, with all vectors there.

The number of hashes follows from the number of vectors (``geometry``): buckets hold about
``BUCKET_ROWS`` vectors, up to the largest number of hashes whose recall was measured.  The finer the buckets, the
more of them a query must probe for the same recall, so ``PROBES`` grows with the number of hashes.  A bucket that holds more is cut into pieces by a hash, each
probed by itself, so no task holds more than a piece at once; only the best ``k + 1`` of a piece leave it.
Equal vectors are indexed once, with their ``k + 1`` smallest ids, and equal queries searched once; a
vector that makes up a third of all rows costs no more than others.  A query that finds fewer than
``k`` neighbours is compared with every bucket of the first table, which is exact.

Defined results: vectors that are null, zero, or hold null or non-finite components, and rows with a null id,
take no part; vectors of different length are never neighbours; rows with the query's id are its own; ties go to
the smaller id; an empty table, or one without other vectors, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.common import arrow_batches, materialize

TABLES = 16
#: Axes of a hash that make up the probes, by the number of hashes: recall of 0.9 and more on the given 64-dimensional vectors.
PROBES = (8, 14, 24)
#: Probes that a task holds at once.
PROBE_ROWS = 65_536
ROUNDS = 3
BUCKET_ROWS = 4096
PIECE_ROWS = 4096
K = 5
SEED = 20_011
_CELL = ["dim", "t", "bucket"]


def geometry(vectors: int, dim: int) -> int:
    """Hashes of a table for buckets of about ``BUCKET_ROWS``; one at least, and no more than ``PROBES`` has a number for."""
    sides = 2 * _padded(dim)
    return min(len(PROBES), max(1, round(math.log(max(vectors / BUCKET_ROWS, 1)) / math.log(sides))))


def _padded(dim: int) -> int:
    return 1 << max(dim - 1, 0).bit_length()


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows whose length is a power of two, scaled to keep lengths."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def rotate(x: np.ndarray, table: int, number: int) -> np.ndarray:
    """The pseudo-rotation of hash ``number`` of a table."""
    n = _padded(x.shape[1])
    out = np.zeros((len(x), n))
    out[:, :x.shape[1]] = x
    for signs in np.random.default_rng([SEED, table, number, n]).integers(0, 2, (ROUNDS, n)) * 2 - 1:
        out = hadamard(out * signs)
    return out


def buckets(x: np.ndarray, table: int, hashes: int) -> np.ndarray:
    """The bucket of each row: its nearest signed axes, read as digits."""
    out = np.zeros(len(x), np.int64)
    for number in range(hashes):
        y = rotate(x, table, number)
        axis = np.abs(y).argmax(axis=1)
        out = out * 2 * y.shape[1] + 2 * axis + (y[np.arange(len(y)), axis] < 0)
    return out


def probes(x: np.ndarray, table: int, hashes: int, count: int) -> np.ndarray:
    """The ``count ** hashes`` buckets of each row that fit it best, taken hash by hash."""
    out, fit = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    for number in range(hashes):
        y = rotate(x, table, number)
        signed = np.stack([y, -y], axis=2).reshape(len(y), -1)
        wide = min(signed.shape[1], 2 * count) if hashes > 1 else min(signed.shape[1], count)
        best = np.argsort(-signed, axis=1, kind="stable")[:, :wide]
        out = (out[:, :, None] * signed.shape[1] + best[:, None, :]).reshape(len(x), -1)
        fit = (fit[:, :, None] + np.take_along_axis(signed, best, axis=1)[:, None, :]).reshape(len(x), -1)
        keep = np.argsort(-fit, axis=1, kind="stable")[:, :count ** (number + 1)]
        out, fit = np.take_along_axis(out, keep, axis=1), np.take_along_axis(fit, keep, axis=1)
    return out


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _addressed(vectors: DataFrame, hashes: dict[int, int], tables: int, counts: dict[int, int] | None) -> DataFrame:
    """One row for each vector and table (``counts`` None) or for each probe."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column(2), dim)
                x = x / np.linalg.norm(x, axis=1)[:, None]
                step = len(x) if counts is None else max(1, PROBE_ROWS // counts[dim] ** hashes[dim])
                for t, a in ((t, a) for t in range(tables) for a in range(0, len(x), step)):
                    some = x[a:a + step]
                    cells = buckets(some, t, hashes[dim])[:, None] if counts is None else probes(some, t, hashes[dim], counts[dim])
                    row = np.repeat(np.arange(a, a + len(some)), cells.shape[1])
                    yield pa.RecordBatch.from_arrays(
                        [*[part.column(i).take(pa.array(row)) for i in range(3)], pa.array(np.full(len(row), t, np.int32)), pa.array(cells.ravel())],
                        ["rep", "dim", "vec", "t", "bucket"])

    return vectors.mapInArrow(run, "rep bigint, dim int, vec array<float>, t int, bucket bigint")


def _nearest(rows: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` best of every query within every piece of a bucket; ``rows`` have ``kind`` 0 (vector) or 1 (query)."""

    def best(scores: np.ndarray, reps: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        edge = -np.partition(-scores, min(keep, scores.shape[1]) - 1, axis=1)[:, min(keep, scores.shape[1]) - 1]
        for i, least in enumerate(edge.tolist()):
            at = np.flatnonzero(scores[i] >= least)
            yield i, at[np.lexsort((reps[at], -scores[i, at]))][:keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, ids = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(5)], axis=1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                *own, kind = keys[a].tolist()
                if own != cell:
                    cell, held, ids = own, [], []
                x, rep = _matrix(batch.column(6).slice(a, b - a), own[0]), batch.column(5).slice(a, b - a).to_numpy()
                if kind == 0:
                    held.append(x)
                    ids.append(rep)
                elif held:
                    if len(held) > 1:
                        held, ids = [np.concatenate(held)], [np.concatenate(ids)]
                    scores = (x @ held[0].T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(held[0], axis=1))
                    for i, at in best(scores, ids[0]):
                        out.append((np.full(len(at), rep[i]), ids[0][at], scores[i, at]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query", "rep", "score"])

    order = [*_CELL, "piece"]
    sorted_rows = rows.repartition(*order).sortWithinPartitions(*order, "kind", "rep")
    return sorted_rows.select(*order, "kind", "rep", "vec").mapInArrow(run, "query bigint, rep bigint, score double")


def _searched(index: DataFrame, asked: DataFrame, keep: int) -> DataFrame:
    """Exact comparison of every probe with the vectors of its bucket: ``query, rep, score``, the best ``keep`` of each query."""
    full = materialize(index.groupBy(*_CELL).count().where(F.col("count") > PIECE_ROWS)
                       .withColumn("pieces", F.ceil(F.col("count") / PIECE_ROWS).cast("int")).drop("count"), "ann-large")
    pieces = F.coalesce("pieces", F.lit(1))
    vectors = index.join(full, _CELL, "left").withColumn("piece", F.pmod(F.xxhash64("rep"), pieces).cast("int")).withColumn("kind", F.lit(0))
    probed = (asked.join(full, _CELL, "left").withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
              .withColumn("kind", F.lit(1)))
    columns = [*_CELL, "piece", "kind", "rep", "vec"]
    found = _nearest(vectors.select(*columns).unionByName(probed.select(*columns)), keep)
    once = found.groupBy("query", "rep").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "rep"))
    return once.withColumn("place", rank).where(F.col("place") <= keep).drop("place")


def search(vectors: DataFrame, is_query, k: int = K, key: str = "vec_id", vector: str = "embedding",  # noqa: ANN001
           tables: int = TABLES, count: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row for which ``is_query(id)`` holds.

    ``count``: axes of a hash to probe, instead of those of ``PROBES``."""
    spark = vectors.sparkSession
    arrow_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    v = F.col("vec")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vec"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0))
    # A partial limit precedes the shuffle: no more than k + 1 rows of a vector leave a task.
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    least = rows.withColumn("place", place).where(F.col("place") <= k + 1)
    distinct = materialize(least.groupBy("vec").agg(F.min("id").alias("rep"), F.array_sort(F.collect_set("id")).alias("ids"))
                           .select("rep", F.size("vec").cast("int").alias("dim"), "vec", "ids"), "ann-vectors")
    hashes = {r["dim"]: geometry(r["n"], r["dim"]) for r in distinct.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = {dim: PROBES[n - 1] if count is None else count for dim, n in hashes.items()}
    index = materialize(_addressed(distinct.select("rep", "dim", "vec"), hashes, tables, None), "ann-index")
    queries = rows.where(is_query(F.col("id")))
    asked_vectors = materialize(queries.groupBy("vec").agg(F.min("id").alias("rep")).select("rep", F.size("vec").cast("int").alias("dim"), "vec"), "ann-queries")
    # Which search answers which query row.
    members = materialize(queries.join(asked_vectors.select("vec", F.col("rep").alias("query")), "vec")
                          .select(F.col("id").alias("query_id"), "query").distinct(), "ann-members")
    found = materialize(_searched(index, _addressed(asked_vectors, hashes, tables, counts), k + 1), "ann-found")
    ids = distinct.select("rep", "ids")

    def best_ids(pairs: DataFrame) -> DataFrame:
        each = pairs.join(ids, "rep").select("query", "score", F.explode("ids").alias("vec_id"))
        order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        return each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).drop("place")

    best = materialize(best_ids(found), "ann-best")
    enough = best.groupBy("query").count().where(F.col("count") > k).select(F.col("query").alias("rep"))
    short = materialize(asked_vectors.join(enough, "rep", "left_anti"), "ann-short")
    if not short.isEmpty():
        every = index.where("t = 0").select(*_CELL).distinct()
        rest = best_ids(_searched(index.where("t = 0"), short.join(every, "dim"), k + 1))
        best = best.join(short.select(F.col("rep").alias("query")), "query", "left_anti").unionByName(rest)
    others = members.join(best, "query").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return others.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
