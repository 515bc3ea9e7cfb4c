"""Mixing sources to target weights by capped water-filling.

Each source's target is its share of all words by weight, clamped at a maximum
number of epochs; what a clamped source can't take is shared again by weight
until no target exceeds its clamp.  The fixed point is found in closed form: with
sources ordered by clamp over weight, a prefix is clamped and the others stand at one level.
A source is then taken ``whole`` times in full, and once more for the documents
whose seeded ticket is at most a threshold, set so that their words reach the
fraction that is left (off by half a document at most).

DataFrame operations only.  Sums are pre-aggregated by source and ticket bucket
(``BUCKETS`` each), so a source with a third of all rows meets in no task; the exact
threshold needs one bucket of each source.  One row per source passes through one
task; that table has the size of the mixture's configuration.

Defined results: a null source is a source of its own, last in order; a null or
empty text has size 0 and is taken 0 words; rows with the same id share a ticket;
no words at all give targets of 0; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.common import HEAVY, materialize, n_words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of a ticket that name its bucket.
BUCKET_DIGITS = 3


def source_key(source: Column) -> Column:
    """A key that is never null and sorts by code point, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def ticket(key: Column, seed: str = SEED) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit("null"))))


def water_levels(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of ``(source_key, source_size)`` rows; adds ``target``."""
    order = Window.partitionBy(F.lit(0)).orderBy("source_key")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("clamp", F.col("source_size") * float(epochs))
    every = Window.partitionBy(F.lit(0))
    rising = every.orderBy(F.col("clamp") / F.col("weight"), "source_key").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("clamp").over(rising), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(rising), F.lit(0.0)))
    found = rows.withColumn("level", level)
    free = F.min(F.when(F.col("clamp") / F.col("weight") >= F.col("level"),
                        F.struct(F.col("clamp") / F.col("weight"), F.col("source_key"), F.col("level")))).over(every)["level"]
    return found.withColumn("target", F.least("clamp", F.coalesce(free, F.lit(0.0)) * F.col("weight"))).drop("level", "clamp", "weight")


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """One narrow row per document: id, source, words, ticket."""
    return docs.select(F.col(key).alias("doc_id"), source_key(F.col(source)).alias("source_key"),
                       n_words(F.col(text)).alias("size"), ticket(F.col(key), seed).alias("ticket"))


def plan_mix(measured: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MAX_EPOCHS) -> DataFrame:
    """``source_key, source_size, target, whole, threshold`` of every source."""
    bucket = F.substring("ticket", 1, BUCKET_DIGITS)
    sums = materialize(measured.groupBy("source_key", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-sums")
    targets = water_levels(sums.groupBy("source_key").agg(F.sum("words").alias("source_size")), weights, epochs)
    # Less than a millionth of a word above a whole number of epochs is rounding.
    whole = F.least(F.floor(F.col("target") / F.greatest("source_size", F.lit(1)) + 1e-12), F.lit(epochs)).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("rest", F.greatest(F.col("target") - whole * F.col("source_size"), F.lit(0.0)))
    so_far = Window.partitionBy("source_key").orderBy("bucket")
    # The bucket in which the running sum passes the rest; its documents are ordered exactly.
    passing = (sums.withColumn("upto", F.sum("words").over(so_far)).withColumn("before", F.col("upto") - F.col("words"))
               .join(targets.select("source_key", "rest"), "source_key")
               .where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("upto")))
               .select("source_key", "bucket", "before", "rest"))
    edge = measured.withColumn("bucket", bucket).join(F.broadcast(passing) if _few(targets) else passing, ["source_key", "bucket"])
    running = Window.partitionBy("source_key").orderBy("ticket").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # A document is taken when the middle of its words lies within the rest.
    exact = (edge.groupBy("source_key", "bucket", "before", "rest", "ticket").agg(F.sum("size").alias("size"))
             .withColumn("middle", F.col("before") + F.sum("size").over(running) - F.col("size") / 2)
             .where("middle <= rest").groupBy("source_key").agg(F.max("ticket").alias("inside")))
    return materialize(
        targets.join(passing.select("source_key", "bucket"), "source_key", "left").join(exact, "source_key", "left")
        .select("source_key", "source_size", "target", "whole",
                # Every ticket of earlier buckets is smaller than the bucket's own name.
                F.coalesce("inside", "bucket", F.lit("")).alias("threshold")), "mix-plan")


def _few(sources: DataFrame) -> bool:
    return sources.limit(HEAVY + 1).count() <= HEAVY


def epochs_of(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Adds the plan's columns and ``times`` (whole and fractional repetitions) to rows with ``source_key`` and ``ticket``.

    Up to ``HEAVY`` sources the plan is broadcast and no row moves; beyond that the join is a shuffle."""
    return rows.join(F.broadcast(plan) if _few(plan) else plan, "source_key").withColumn(
        "times", F.col("whole") + (F.col("ticket") <= F.col("threshold")).cast("long"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS,
        epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with the columns it had."""
    plan = plan_mix(materialize(measure(docs, key, text, source, seed), "mix-rows"), weights, epochs).select("source_key", "whole", "threshold")
    columns = [F.col(f"doc.`{c}`") for c in docs.columns]
    rows = docs.select(F.struct("*").alias("doc"), source_key(F.col(source)).alias("source_key"), ticket(F.col(key), seed).alias("ticket"))
    taken = epochs_of(rows, plan).where("times > 0")
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))).alias("copy")).select(*columns)


def shares(docs: DataFrame, **options: object) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every document."""
    measured = materialize(measure(docs), "mix-rows")
    return epochs_of(measured, plan_mix(measured, **options)).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


SHARES_SQL = rf"""
WITH m AS (
  SELECT doc_id, coalesce(source, '') AS s, source IS NULL AS no_source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')) AS ticket
  FROM documents),
sizes AS (SELECT s, no_source, sum(size)::BIGINT AS source_size FROM m GROUP BY ALL),
weighed AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY no_source, s) - 1) % 3 + 1)::INT] AS weight,
         source_size * {MAX_EPOCHS}.0::DOUBLE AS clamp FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(clamp) OVER o, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER o, 0)) AS level
  FROM weighed
  WINDOW o AS (ORDER BY clamp / weight, no_source, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
one AS (SELECT level FROM levels WHERE clamp / weight >= level ORDER BY clamp / weight, no_source, s LIMIT 1),
targets AS (
  SELECT s, no_source, source_size, least(clamp, coalesce((SELECT level FROM one), 0) * weight) AS target FROM levels),
plan AS (
  SELECT *, least(floor(target / greatest(source_size, 1) + 1e-12), {MAX_EPOCHS})::BIGINT AS whole FROM targets),
running AS (
  SELECT m.*, source_size, target, whole, greatest(target - whole * source_size, 0) AS rest,
         sum(size) OVER (PARTITION BY m.s, m.no_source ORDER BY ticket) - size / 2.0 AS middle
  FROM m JOIN plan USING (s, no_source))
SELECT doc_id, size, source_size, target, size * (whole + CASE WHEN middle <= rest THEN 1 ELSE 0 END)::BIGINT AS taken FROM running
"""
