"""Speed layer operators: record parsing, hashtag summary, archive selection.

They are written against plain DataFrames, so the same functions serve a
static DataFrame (batch check) and a streaming one (``readStream``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.functions.text import extract_hashtag, has_hashtag, made_once
from tagpulse.functions.timeparse import parse_event_time
from tagpulse.schemas import RAW_POST


def to_records(posts: DataFrame) -> DataFrame:
    """K1 payload: ``key`` = id, ``value`` = JSON of ``{id, text, created}``."""
    return posts.select(
        F.col("id").cast("string").alias("key"),
        F.to_json(F.struct("id", "text", "created")).alias("value"),
    )


def _parsed(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Every record once through the JSON parser: ``value`` and the parsed ``p``."""
    return records.select(F.col(value_col).alias("value"), F.from_json(F.col(value_col), RAW_POST).alias("p"))


def _usable(parsed: DataFrame) -> DataFrame:
    """records with an id and a text; others can be neither keyed nor read."""
    return parsed.where(F.col("p.id").isNotNull() & F.col("p.text").isNotNull())


def parse_records(records: DataFrame, value_col: str = "value") -> DataFrame:
    """P3 + F3: JSON value -> ``id, text, created``.

    Malformed lines and lines without ``id`` or ``text`` are dropped (the
    original would fail the task on them); ``rejected_records`` has them.
    """
    return _usable(_parsed(records, value_col)).select("p.id", "p.text", "p.created")


def rejected_records(records: DataFrame, value_col: str = "value") -> DataFrame:
    """The records that ``parse_records`` drops, to count or keep."""
    parsed = _parsed(records, value_col)
    return parsed.where(F.col("p.id").isNull() | F.col("p.text").isNull()).select("value")


def _reason() -> Column:
    return (F.when(F.col("value").isNull(), "no value").when(~F.coalesce(F.col("value").rlike(r"^\s*\{"), F.lit(False)), "no object")
            .when(F.col("p.id").isNull() & F.col("p.text").isNull(), "no id and text").when(F.col("p.id").isNull(), "no id")
            .when(F.col("p.text").isNull(), "no text"))


def rejected_with_reason(parsed: DataFrame) -> DataFrame:
    """``key, value, reason`` of parsed records (``key, value, p``) that can't be used.

    A missing value, a value that is no JSON object, and an object without an id or a text are told apart."""
    return parsed.select("key", "value", _reason().alias("reason")).where(F.col("reason").isNotNull())


def post_day(created: Column) -> Column:
    """The day of a post's time, in UTC (1970-01-01 when it can't be parsed)."""
    return F.to_date(F.timestamp_seconds(parse_event_time(created)))


def texts(records: DataFrame) -> DataFrame:
    """The text of every record (the same parser and rule as P3)."""
    return parse_records(records).select("text")


def with_hashtag(posts: DataFrame) -> DataFrame:
    """``hashtag`` column ("" when the post has none)."""
    return made_once(posts, "hashtag", extract_hashtag("text"))


def summarize(posts: DataFrame) -> DataFrame:
    """P4 + P5 + F1: ``_id, hashtag, time`` for posts that carry a hashtag."""
    return summary_rows(with_hashtag(posts).where(F.col("hashtag") != ""))


def summary_rows(tagged: DataFrame) -> DataFrame:
    """P5 of posts that have their hashtag already."""
    return tagged.select(F.col("id").alias("_id"), "hashtag", F.col("created").alias("time"))


def archive_lines(records: DataFrame, value_col: str = "value") -> DataFrame:
    """F2 + K3: raw JSON lines of the posts whose text matches the pattern."""
    return _usable(_parsed(records, value_col)).where(has_hashtag(F.col("p.text"))).select("value")


def archive_of_posts(posts: DataFrame) -> DataFrame:
    """F2 + K3 for posts that are parsed already: the text is tested before the line is rendered."""
    return to_records(posts.where(has_hashtag("text"))).select("value")


def parsed_records(records: DataFrame) -> DataFrame:
    """Every record once through parser and match: ``key, value, p, hashtag``; nothing is dropped."""
    parsed = made_once(records.select("key", "value"), "p", F.from_json("value", RAW_POST))
    return made_once(parsed, "hashtag", extract_hashtag(F.col("p.text")))


def tagged_records(parsed: DataFrame) -> DataFrame:
    """The outputs of the speed layer as columns of parsed records: ``value, _id, hashtag, time, text``."""
    return _usable(parsed).where(F.col("hashtag") != "").select(
        "value", F.col("p.id").alias("_id"), "hashtag", F.col("p.created").alias("time"), F.col("p.text").alias("text"))


def tagged_or_rejected(parsed: DataFrame) -> DataFrame:
    """``tagged_records`` and ``rejected_with_reason`` as one table: ``key, value, reason, _id, hashtag, time, text, tagged`` (a record can be both)."""
    usable = F.col("p.id").isNotNull() & F.col("p.text").isNotNull()
    rows = parsed.select("key", "value", _reason().alias("reason"), F.col("p.id").alias("_id"), "hashtag", F.col("p.created").alias("time"),
                         F.col("p.text").alias("text"), (usable & (F.col("hashtag") != "")).alias("tagged"))
    return rows.where(F.col("reason").isNotNull() | F.col("tagged"))
