"""Post time strings: rendering (ingest side) and parsing to epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# A post's ``created`` is the JVM ``Date.toString()`` form, e.g.
# "Wed Jun 16 12:34:56 CEST 2021"; ingest removes the colons, giving
# "Wed Jun 16 123456 CEST 2021".  Parse failures map to 0.
DATE_TOSTRING_UTC = "EEE MMM dd HH:mm:ss 'UTC' yyyy"
# Spark 4 rejects the weekday and the long zone name when parsing, so the
# weekday is dropped and the short zone pattern is used.
WEEKDAY_PREFIX = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) "
CREATED_PARSE = "MMM dd HHmmss z yyyy"
PARSE_FAILURE = 0
SQL_FUNCTION_NAME = "toTimestamp"
# ---------------------------------------------------------------------------


def render_created(ts: Column | str) -> Column:
    """``Date.toString()`` rendering of a UTC timestamp (before normalisation)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, DATE_TOSTRING_UTC)


def parse_event_time(time: Column | str) -> Column:
    """Epoch seconds of a normalised ``created`` string; 0 when it
    cannot be parsed (NULL included).  Built-in expression, no UDF."""
    c = F.col(time) if isinstance(time, str) else time
    return F.when(c.rlike(WEEKDAY_PREFIX), F.coalesce(F.unix_timestamp(F.try_to_timestamp(
        F.regexp_replace(c, WEEKDAY_PREFIX, ""), F.lit(CREATED_PARSE))), F.lit(PARSE_FAILURE).cast("long"))) \
        .otherwise(F.lit(PARSE_FAILURE).cast("long"))


def register_sql_function(spark: SparkSession, name: str = SQL_FUNCTION_NAME) -> None:
    """Expose the parser to SQL users under a name.

    A SQL function body is inlined by the analyzer, so SQL callers get the
    same codegen'd expression as DataFrame callers.
    """
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS BIGINT RETURN "
        f"CASE WHEN t RLIKE '{WEEKDAY_PREFIX}' THEN coalesce(unix_timestamp(try_to_timestamp("
        f"regexp_replace(t, '{WEEKDAY_PREFIX}', ''), '{CREATED_PARSE}')), {PARSE_FAILURE}) ELSE {PARSE_FAILURE} END"
    )
