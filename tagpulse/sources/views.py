"""Readers of the serving views and of the raw archive.

Views are written as one folder per micro-batch (``batch_id=N``) so that a
replayed batch overwrites itself; readers keep one row per post (the
earliest batch), which also absorbs posts seen twice by the producer (D6).
``summary_view`` is the keyed form that the jobs use: a later batch replaces a post's row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tagpulse.operators.speed import parse_records
from tagpulse.schemas import SENTIMENT, SUMMARY
from tagpulse.sinks.keyed import KeyedView
from tagpulse.sinks.writers import batches, latest_version


def _batched(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    """Rows of all ``batch_id=N`` folders, with ``batch_id`` as a column."""
    with_batch = StructType(list(schema.fields) + [StructField("batch_id", LongType())])
    folders = [f"{path}/batch_id={b}" for b in batches(spark, path)]
    if not folders:
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).option("basePath", path).format(fmt).load(folders)


def read_summary_view(spark: SparkSession, path: str, hashtag: str | None = None, fmt: str = "parquet",
                      upto: int | None = None) -> DataFrame:
    """S3: ``_id, hashtag, time``, one row per post: that of the earliest batch (of one batch, the smallest).

    The newest compacted table and the batches after it (``upto``: no later than that).  A look-up's filter on the
    hashtag reaches the scan; its few rows are then compared with the post's rows under other
    hashtags, of which only the key and the batch are read.
    """
    done = latest_version(spark, f"{path}/compacted")
    rows = _batched(spark, path, SUMMARY, fmt)
    if done is not None:
        old = spark.read.schema(SUMMARY).format(fmt).load(f"{path}/compacted/version={done}").select(*SUMMARY.names)
        rows = rows.where(F.col("batch_id") > done).unionByName(old.withColumn("batch_id", F.lit(done).cast("long")))
    if upto is not None:
        rows = rows.where(F.col("batch_id") <= upto)
    rows = rows.where(F.col("_id").isNotNull())
    first = F.min(F.struct("batch_id", "hashtag", "time")).alias("r")
    if hashtag is None:
        return rows.groupBy("_id").agg(first).select("_id", "r.hashtag", "r.time")
    found = rows.where(F.col("hashtag") == F.lit(hashtag)).groupBy("_id").agg(first)
    others = rows.where(F.col("hashtag") != F.lit(hashtag)).select("_id", "batch_id", "hashtag").join(found.select("_id"), "_id", "left_semi")
    others = others.groupBy("_id").agg(F.min(F.struct("batch_id", "hashtag")).alias("o"))
    earlier = F.struct(F.col("r.batch_id").alias("batch_id"), F.col("r.hashtag").alias("hashtag")) > F.col("o")
    return found.join(others, "_id", "left").where(~F.coalesce(earlier, F.lit(False))).select("_id", "r.hashtag", "r.time")


def summary_view(spark: SparkSession, path: str) -> KeyedView:
    """S3 as a keyed view: ``summary_view(...).read(F.col("hashtag") == tag)``."""
    return KeyedView(spark, path, SUMMARY)


def read_sentiment_view(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``_id, text, sentiment`` as last written by the batch job."""
    version = latest_version(spark, path)
    if version is None:
        return spark.createDataFrame([], SENTIMENT)
    return spark.read.schema(SENTIMENT).format(fmt).load(f"{path}/version={version}")


def read_archive_days(spark: SparkSession, path: str) -> DataFrame:
    """S2 by date: ``value, date, batch_id``; a condition on the date reads only its folders."""
    return spark.read.schema("value string, date date, batch_id bigint").text(path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Archived JSON lines -> ``id, text, created`` (bad lines dropped).

    ``path`` may be a folder of ``batch_id=N`` sub-folders or a glob.
    """
    lines = spark.read.text(path).select("value")
    return parse_records(lines)
