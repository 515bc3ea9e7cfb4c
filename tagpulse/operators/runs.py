"""W1 kept up to date: run summaries that combine associatively.

What a stretch of one hashtag's posts, in the order of time and ``_id``, means to its surroundings is a short summary:

* ``lead_n, lead_start``: its positive posts before the first non-positive one, and when they begin;
* ``end``: the time of that first non-positive post (null: all are positive);
* ``tail_n, tail_start``: its positive posts after the last non-positive one.

Everything between is closed and never changes again.  A single post is such a stretch, and ``fold`` joins neighbouring
stretches of any size: it returns the intervals that close between them and one summary for each group.  Folding posts to slices,
slices to spans and spans to the whole gives the same intervals as sorting all posts, whatever the cuts.

``RunView`` keeps that up to date.  Posts, slice summaries and closed intervals lie in folders by span: a day, or, of posts without a
parsable time (timestamp 0), those whose ids begin alike.  A manifest says which version of a span counts.  New posts touch their spans:
only those are read, sorted and summarised again, and committed in one step.  A slice is an hour of a span, and a range partitioning
by ``(hashtag, timestamp, _id)`` cuts a slice with many posts into pieces, so a hot hashtag, or a hot second, is many stretches.

A post that comes again in its span replaces its row.  Posts without an id or a hashtag take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagpulse.operators.sentiment import POSITIVE_LABEL
from tagpulse.session import delete_path, stored
from tagpulse.sinks import manifest
from tagpulse.sinks.writers import folders

SLICE_SECONDS, DAY_SECONDS = 3600, 86400
#: Characters of the id that tell spans of posts without a time apart.
UNTIMED_PREFIX = 2
SUMMARY = ["lead_n", "lead_start", "end", "tail_n", "tail_start"]
SPAN = ["day", "part"]
_SPAN = "day bigint, part string"
TABLES = {
    "posts": f"hashtag string, timestamp bigint, _id string, np bigint, slice bigint, piece int, {_SPAN}",
    "slices": f"hashtag string, slice bigint, piece int, lead_n bigint, lead_start bigint, end bigint, tail_n bigint, tail_start bigint, {_SPAN}",
    "closed": f"hashtag string, start_ts bigint, end_ts bigint, tweets bigint, {_SPAN}",
}


def posts_as_runs(rows: DataFrame) -> DataFrame:
    """Each post (``hashtag, timestamp, _id, np``) as a stretch of its own; other columns pass."""
    positive = F.col("np") == 0
    nothing = F.lit(None).cast("long")
    return rows.select(
        *rows.columns, F.when(positive, 1).otherwise(0).cast("long").alias("lead_n"), F.when(positive, F.col("timestamp")).alias("lead_start"),
        F.when(~positive, F.col("timestamp")).alias("end"), F.lit(0).cast("long").alias("tail_n"), nothing.alias("tail_start"))


def fold(runs: DataFrame, groups: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Join neighbouring stretches of each hashtag and group.

    Returns the intervals that close between them (``hashtag, *groups, start_ts, end_ts, tweets``) and the groups' own
    summaries (``hashtag, *groups`` and the summary's columns).

    A stretch with a non-positive post ends the run that comes in and begins the one that goes out, so it is two parts; runs are numbered
    by the non-positive stretches before them.  Run 0 is the group's lead, a later one without an end its tail; the others are closed."""
    by = ["hashtag", *groups]
    before = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    run = F.coalesce(F.sum(F.col("end").isNotNull().cast("long")).over(before), F.lit(0))
    nothing = F.lit(None).cast("long")
    incoming = F.struct(F.col("run").alias("run"), F.col("lead_n").alias("n"), F.col("lead_start").alias("start"), F.col("end").alias("end"))
    outgoing = F.struct((F.col("run") + 1).alias("run"), F.col("tail_n").alias("n"), F.col("tail_start").alias("start"), nothing.alias("end"))
    parts = runs.select(*by, run.alias("run"), *SUMMARY).select(
        *by, F.explode(F.when(F.col("end").isNull(), F.array(incoming)).otherwise(F.array(incoming, outgoing))).alias("p")).select(*by, "p.*")
    joined = parts.groupBy(*by, "run").agg(F.sum("n").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"))
    inside = (F.col("run") > 0) & F.col("end").isNotNull()
    closed = joined.where(inside & (F.col("n") > 0)).select(*by, F.col("start").alias("start_ts"), F.col("end").alias("end_ts"), F.col("n").alias("tweets"))
    first, last = F.col("run") == 0, (F.col("run") > 0) & F.col("end").isNull()
    of = lambda which, column: F.max(F.when(which, F.col(column)))
    summaries = joined.where(first | last).groupBy(*by).agg(
        of(first, "n").alias("lead_n"), of(first, "start").alias("lead_start"), of(first, "end").alias("end"),
        F.coalesce(of(last, "n"), F.lit(0)).alias("tail_n"), of(last, "start").alias("tail_start"))
    return closed, summaries


def labelled_posts(joined: DataFrame) -> DataFrame:
    """``hashtag, timestamp, _id, np`` of posts with their sentiment."""
    return joined.select("hashtag", "timestamp", "_id", (F.col("sentiment") != POSITIVE_LABEL).cast("long").alias("np"))


def _numbered_time(seconds: int) -> Column:
    """A number that grows with time; 0 is for posts without a time alone."""
    at = F.col("timestamp")
    return F.floor(at / seconds).cast("long") + (at > 0).cast("long")


def placed(rows: DataFrame) -> DataFrame:
    """Adds each post's slice and span.  A span's ``part`` is in hexadecimal, which sorts like the ids."""
    part = F.when(F.col("timestamp") == 0, F.hex(F.encode(F.substring("_id", 1, UNTIMED_PREFIX), "UTF-8"))).otherwise(F.lit("t"))
    return rows.withColumns({"slice": _numbered_time(SLICE_SECONDS), "day": _numbered_time(DAY_SECONDS), "part": part})


def _columns(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table].split(", ")]


class RunView:
    """The intervals of all hashtags under ``path``, kept up to date by ``update``."""

    def __init__(self, spark: SparkSession, path: str, pieces: int | None = None) -> None:
        self.spark, self.path, self.pieces = spark, path.rstrip("/"), pieces

    def _state(self) -> tuple[int, dict[str, dict[str, int]]]:
        """The newest manifest: for each table the version of each span."""
        found = manifest.read(self.spark, self.path)
        return (found[0], found[1]) if found else (-1, {t: {} for t in TABLES})

    def _read(self, table: str, spans: dict[str, int]) -> DataFrame:
        folders = [f"{self.path}/{table}/version={v}/{span}" for span, v in sorted(spans.items())]
        if not folders:
            return self.spark.createDataFrame([], TABLES[table])
        read = self.spark.read.schema(f"{TABLES[table]}, version int").option("basePath", f"{self.path}/{table}")
        return read.parquet(*folders).select(*_columns(table))

    def _write(self, table: str, rows: DataFrame, version: int) -> dict[str, int]:
        """Rows in folders by span; returns the spans that have any."""
        path = f"{self.path}/{table}/version={version}"
        rows.select(*_columns(table)).write.mode("overwrite").partitionBy(*SPAN).parquet(path)
        return {f"{day}/{part}": version for day in folders(self.spark, path, "day=") for part in folders(self.spark, f"{path}/{day}", "part=")}

    def update(self, posts: DataFrame) -> list[str]:
        """Take new ``hashtag, timestamp, _id, np`` rows; returns the spans that were summarised again."""
        version, state = self._state()
        made = version + 1
        keys = ["hashtag", "_id", *SPAN]
        new = stored(placed(posts.select("hashtag", "timestamp", "_id", "np").where("_id is not null and hashtag is not null")), "new-posts")
        touched = sorted(f"day={r['day']}/part={r['part']}" for r in new.select(*SPAN).distinct().collect())
        if not touched:
            return []
        old = self._read("posts", {s: state["posts"][s] for s in touched if s in state["posts"]})
        values = ["timestamp", "np", "slice"]
        once = new.groupBy(*keys).agg(F.min(F.struct(*values)).alias("r")).select(*keys, *[f"r.{c}" for c in values])
        kept = old.join(new.select(*keys).distinct(), keys, "left_anti")
        rows = stored(kept.select(*once.columns).unionByName(once), "span-posts")
        # Dealt in order, span by span, in pieces of like size, and written with the piece: a retried task can't deal them anew.
        pieces = self.pieces or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = rows.repartitionByRange(pieces, *SPAN, "hashtag", "timestamp", "_id").withColumn("piece", F.spark_partition_id())
        written = {"posts": self._write("posts", dealt, made)}
        closed, slices = fold(posts_as_runs(self._read("posts", written["posts"])), [*SPAN, "slice", "piece"], ["timestamp", "_id"])
        written |= {"slices": self._write("slices", slices.repartition(*SPAN), made), "closed": self._write("closed", closed.repartition(*SPAN), made)}
        manifest.commit(self.spark, self.path, made, {
            t: {**{s: v for s, v in state[t].items() if s not in set(touched)}, **written[t]} for t in TABLES})
        self._tidy()
        return touched

    def _tidy(self) -> None:
        """Delete what only manifests before the last two name."""
        named = lambda found: {(t, s, v) for body in found for t in TABLES for s, v in body[t].items()}
        gone = manifest.forget(self.spark, self.path, keep=2)
        kept = [manifest.read(self.spark, self.path, v)[1] for v in manifest.versions(self.spark, self.path)]
        for table, span, version in named(gone) - named(kept):
            delete_path(self.spark, f"{self.path}/{table}/version={version}/{span}")

    def intervals(self) -> DataFrame:
        """``hashtag, start_ts, end_ts, seconds, tweets``: closed inside slices, between the slices of a span, between spans, and at the beginning."""
        state = self._state()[1]
        inside = self._read("closed", state["closed"]).select("hashtag", "start_ts", "end_ts", "tweets")
        in_span, spans = fold(self._read("slices", state["slices"]), SPAN, ["slice", "piece"])
        between, whole = fold(spans, [], SPAN)
        return as_intervals([inside, in_span, between], whole)


def as_intervals(closed: list[DataFrame], whole: DataFrame) -> DataFrame:
    """All intervals of the last fold and those before it; ``whole`` are the hashtags' own summaries.

    Nothing comes before a hashtag's first run: its lead is closed by the first non-positive post."""
    out = whole.where("end is not null and lead_n > 0").select(
        "hashtag", F.col("lead_start").alias("start_ts"), F.col("end").alias("end_ts"), F.col("lead_n").alias("tweets"))
    for found in closed:
        out = out.unionByName(found.select(*out.columns))
    return out.select("hashtag", "start_ts", "end_ts", (F.col("end_ts") - F.col("start_ts")).alias("seconds"), "tweets")
