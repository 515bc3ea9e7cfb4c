"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Conservative defaults for local runs; on a cluster these come from the
# submitter and ``get_session`` only fills what is unset.
_LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}

#: Tables of whole texts: denser than Spark's default codec at about its speed.  A file holds so many rows at most, since a dense one
#: unfolds to many times its bytes and is read by one task.
TEXT_ROWS = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "maxRecordsPerFile": "20000"}
#: Bits of the table that ``split_repeated`` broadcasts, 64 to a row: at most a million rows.
REPEATED_BITS = 1 << 26


def get_session(master: str | None = None, app: str = "tagpulse",
                shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in _LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings every query relies on (idempotent).

    Post times are rendered and parsed with an explicit zone name, and the
    parquet ``ts`` column is TIMESTAMP_NTZ, so the session zone must be UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset on a local master (tests, a
    laptop) do we pick one and set it, so checkpoints and job scratch land in
    the same place.  On a cluster a folder of one machine would be lost to the
    others, so an unset folder is an error there.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = os.path.join(os.environ.get("TMPDIR", "/tmp"), "tagpulse-checkpoints")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """This application's own scratch folder; other applications share ``spark.checkpoint.dir`` but not this."""
    context = spark.sparkContext
    if not hasattr(context, "_tagpulse_run"):
        context._tagpulse_run = f"{context.applicationId}-{uuid.uuid4().hex[:8]}"
    return f"{shared_dir(spark)}/tagpulse/{context._tagpulse_run}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path under this run's scratch folder (never reused)."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back: it runs once, the lineage
    is cut, later scans prune its columns and Spark knows its size."""
    return stored_at(df, scratch_path(df.sparkSession, label))


def stored_at(df: DataFrame, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """``stored`` under a path that the caller deletes."""
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_repeated(rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``(once, again)``: rows whose key comes once, where they lie, and all rows of keys that come again.

    A few rows of the first kind are among the second (one in 37 with 1.8 million repeated keys), so whoever takes it groups it by key.
    The keys are counted without the other columns.  The repeated ones set bits in a table of ``REPEATED_BITS`` bits, which is
    broadcast whatever their number is; a join with the keys themselves would move all rows once there are too many of them
    to broadcast.  A null key is a key like others."""
    bit = F.pmod(F.xxhash64(key), F.lit(REPEATED_BITS))
    word, one = F.shiftright(bit, 6), F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bits = F.broadcast(stored(repeated.select(word.alias("bits_word"), one.alias("bit")).groupBy("bits_word").agg(F.bit_or("bit").alias("bits_set")), "repeated-keys"))
    found = (word == F.col("bits_word")) & (F.col("bits_set").bitwiseAND(one) != 0)
    return rows.join(bits, found, "left_anti"), rows.join(bits, found, "left_semi")


@contextmanager
def unless_set(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for what runs inside; the session's own stays."""
    given = spark.conf.get(name, None)
    if given is None:
        spark.conf.set(name, value)
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(name)


@contextmanager
def more_tasks(spark: SparkSession, per_core: int = 16) -> Iterator[None]:
    """For a write inside whose rows grow after their shuffle: AQE merges the small partitions to about one for each core,
    and the one or two left over run alone while the other cores wait.  With few tasks for each core merged partitions
    stand beside single ones and run twice as long.  A setting of the session's own stays."""
    with unless_set(spark, "spark.sql.adaptive.coalescePartitions.minPartitionNum", str(per_core * spark.sparkContext.defaultParallelism)):
        yield


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a folder in whatever store it lies (none: 0)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def delete_scratch(spark: SparkSession) -> bool:
    """Delete this application's scratch tables (results that still read them must be done); others' stay."""
    return delete_path(spark, run_dir(spark))


def ship_package(spark: SparkSession) -> None:
    """Give Python tasks this package, wherever the driver was started (once a session).

    The archive is served by the driver like any ``--py-files`` argument."""
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_tagpulse_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp()) / "tagpulse.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*")):
            if path.suffix in (".py", ".txt"):
                out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tagpulse_shipped = True
