"""J2 and W1 on co-partitioned views: tables hashed into buckets when they are written.

Summary and labels hashed by ``_id`` join without moving a row of either.  Their join is stored hashed by hashtag and slice (an hour, or of
posts without a time those whose ids begin alike), sorted by time: the runs of a slice are found where it lies, and only slice
summaries are moved.  Both tables pay their exchange once, when they are written, and every later query is spared it.

Buckets need a catalog table; the files lie in the folder that the caller names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.operators import runs as R

BUCKETS = 32


def save_bucketed(rows: DataFrame, path: str, keys: list[str], order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Write ``rows`` as a table of buckets by ``keys``, each sorted by ``order``, and return it."""
    name = f"tagpulse_{uuid.uuid4().hex}"
    # One task writes a bucket: the hash is that of the table, so there is one file for each bucket.
    spread = rows.repartition(buckets, *keys)
    spread.write.bucketBy(buckets, *keys).sortBy(*order).option("path", path).format("parquet").saveAsTable(name)
    return rows.sparkSession.table(name)


def by_id(rows: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    return save_bucketed(rows, path, ["_id"], ["_id"], buckets)


def by_slice(posts: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """``hashtag, timestamp, _id, np`` rows by hashtag and slice, in order of time."""
    keys = ["hashtag", "slice", "part"]
    return save_bucketed(R.placed(posts), path, keys, [*keys, "timestamp", "_id"], buckets)


def intervals(sliced: DataFrame) -> DataFrame:
    """W1 of a table made by ``by_slice``: no post row is moved."""
    inside, slices = R.fold(R.posts_as_runs(sliced), ["slice", "part"], ["timestamp", "_id"])
    # Slices to days, so that the last window sees a row a day.
    in_day, days = R.fold(slices.withColumn("day", F.floor(F.col("slice") * R.SLICE_SECONDS / R.DAY_SECONDS)), ["day"], ["slice", "part"])
    between, whole = R.fold(days, [], ["day"])
    return R.as_intervals([inside, in_day, between], whole)
