"""Sinks: record publishing (K1), views (K2, K4), archive (K3), console (K5), upkeep of views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.session import TEXT_ROWS, delete_path, unless_set


def publish_records(records: DataFrame, target: str, fmt: str = "parquet",
                    options: dict[str, str] | None = None) -> None:
    """K1: write ``key, value`` records.

    ``fmt="kafka"`` publishes to a topic (``options`` must name
    ``kafka.bootstrap.servers`` and ``topic``; needs the Kafka connector on
    the classpath); any file format writes under ``target``.
    """
    writer = records.select("key", "value").write
    if fmt == "parquet":
        writer = writer.options(**TEXT_ROWS)
    if options:
        writer = writer.options(**options)
    if fmt == "kafka":
        writer.format("kafka").save()
    else:
        writer.mode("append").format(fmt).save(target)


def write_batch_view(view: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    """K2: one folder per micro-batch; a replay of the batch overwrites it."""
    view.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")


def write_rejected(rejected: DataFrame, path: str, batch_id: int) -> None:
    """T3's third output: records that can't be used, with the reason; a replay of the batch overwrites them."""
    rejected.select("key", "value", "reason").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def write_english(posts: DataFrame, path: str, batch_id: int) -> None:
    """The archived posts of a micro-batch that a language model takes for English: ``id, text``; a replay overwrites them."""
    posts.select("id", "text").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


#: Archived lines are compressed with the fast level of the densest codec that needs no native library; one task reads a file of it,
#: so a file holds so many lines at most.
ARCHIVE_OPTIONS = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "20000"}
#: Days that a task writes to at once.  Lines of more days are sorted by day first, which moves and spills whole lines.
OPEN_DAYS = 64


def write_archive_by_day(lines: DataFrame, path: str, batch_id: int) -> None:
    """K3 by date: ``value, date`` rows to ``date=D/batch_id=N``.

    Only the partitions that the batch has rows for are replaced, so a replay overwrites the batch's own lines of
    each day and no other batch's."""
    with unless_set(lines.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_DAYS)):
        (lines.select("value", "date", F.lit(batch_id).cast("long").alias("batch_id")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").options(**ARCHIVE_OPTIONS).partitionBy("date", "batch_id").text(path))


def write_archive(lines: DataFrame, path: str, batch_id: int) -> None:
    """K3: raw JSON lines, one folder per micro-batch."""
    lines.select("value").write.mode("overwrite").options(**ARCHIVE_OPTIONS).text(f"{path}/batch_id={batch_id}")


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Names under ``path`` that begin with ``prefix``, sorted."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(n for n in names if n.startswith(prefix))


def _numbered(spark: SparkSession, path: str, prefix: str) -> dict[int, bool]:
    """Folders ``prefix=N`` under ``path``: N -> whether its write was completed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(prefix + "=") and name[len(prefix) + 1:].isdigit():
            found[int(name[len(prefix) + 1:])] = fs.exists(hadoop.Path(status.getPath(), "_SUCCESS"))
    return found


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The newest completely written version of a versioned view."""
    return max((n for n, complete in _numbered(spark, path, "version").items() if complete), default=None)


def batches(spark: SparkSession, path: str) -> list[int]:
    return sorted(n for n, complete in _numbered(spark, path, "batch_id").items() if complete)


def write_view(view: DataFrame, path: str, fmt: str = "parquet", version: int | None = None, keep: int = 2,
               folders: tuple[str, ...] = ()) -> int:
    """K4: a new version of a view beside the old ones; returns its number.

    Readers take the newest complete version, so they never see half a view, and
    a failed run leaves the old one readable.  Older than the last ``keep`` go.
    """
    spark = view.sparkSession
    if version is None:
        version = max(_numbered(spark, path, "version"), default=-1) + 1
    view.write.mode("overwrite").partitionBy(*folders).format(fmt).save(f"{path}/version={version}")
    complete = sorted(n for n, done in _numbered(spark, path, "version").items() if done)
    for old in complete[:-keep]:
        delete_path(spark, f"{path}/version={old}")
    return version


def compact_summary(spark: SparkSession, path: str, fmt: str = "parquet") -> int | None:
    """Upkeep of K2: all micro-batches so far as one clustered table, then their folders go.

    The table is ``path/compacted/version=B`` with B the last batch in it: readers add the
    batches after B, and a replay of an older batch changes nothing.  Rows are one per
    post and hashtag, sorted by hashtag, so that a tag's rows lie in few row groups.
    Date folders (of the post's time) let old days be dropped."""
    from tagpulse.functions.timeparse import parse_event_time
    from tagpulse.sources.views import read_summary_view
    found = batches(spark, path)
    done = latest_version(spark, f"{path}/compacted")
    new = [b for b in found if done is None or b > done]
    if new:
        day = F.to_date(F.timestamp_seconds(parse_event_time("time")))
        rows = read_summary_view(spark, path, fmt=fmt, upto=new[-1]).withColumn("date", day)
        # By range of hashtag and time, which also cuts a hot hashtag over several files.
        clustered = rows.repartitionByRange("hashtag", "date", "_id").sortWithinPartitions("date", "hashtag", "_id")
        write_view(clustered, f"{path}/compacted", fmt, version=new[-1], folders=("date",))
        done = new[-1]
    for b in found:
        if done is not None and b <= done:
            delete_path(spark, f"{path}/batch_id={b}")
    return done


def show(view: DataFrame, n: int = 20) -> None:
    """K5: console display in jobs (never in library code paths)."""
    view.show(n, truncate=False)
