"""Named queries over the driver's tables: one per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; all that is
collected is one row per language of the labelled corpus.  Computed columns carry the same names as in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.functions.lexicon import default_lexicon
from tagpulse.functions.timeparse import parse_event_time, register_sql_function
from tagpulse.operators import intervals as I
from tagpulse.jobs import sentiment_of_lines
from tagpulse.operators import language as L
from tagpulse.operators import language_model as LM
from tagpulse.operators import runs as R
from tagpulse.operators import sentiment as S
from tagpulse.operators import speed as SP
from tagpulse.schemas import SUMMARY
from tagpulse.session import more_tasks, prepare, scratch_path, stored
from tagpulse.sinks import bucketed as B
from tagpulse.sinks.increments import SentimentIncrements
from tagpulse.sinks.keyed import KeyedView
from tagpulse.sinks.writers import write_archive
from tagpulse.sources import posts as P
from tagpulse.sources.tables import read_table, spread
from tagpulse.sources.views import read_archive_days

# The hashtag the single-tag serving queries ask about.
SERVING_HASHTAG = "#click"
PREVIEW_ROWS = 20  # show() default of the original's look-up display


def _posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.posts(prepare(spark), sf_dir)


def _archive_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts the speed layer archives (text matches the hashtag pattern)."""
    from tagpulse.functions.text import has_hashtag
    return _posts(spark, sf_dir).where(has_hashtag("text"))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SP.summarize(_posts(spark, sf_dir))


def _sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sentiment_view(_archive_posts(spark, sf_dir), default_lexicon())


def _stemmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.stemmed_english(_archive_posts(spark, sf_dir), default_lexicon())


# ---- ingest / speed layer ---------------------------------------------------------

def q_ingest_normalize(spark, sf_dir):
    raw = P.raw_posts(prepare(spark), sf_dir)
    return P.normalize_posts(raw).select("id", "text", "created")


def q_publish_payload(spark, sf_dir):
    return SP.to_records(_posts(spark, sf_dir))


def q_parse_raw_json(spark, sf_dir):
    return SP.parse_records(SP.to_records(_posts(spark, sf_dir)))


def q_tail_texts(spark, sf_dir):
    return SP.texts(SP.to_records(_posts(spark, sf_dir)))


def q_hashtag_extract(spark, sf_dir):
    return SP.with_hashtag(_posts(spark, sf_dir)).select("id", "hashtag")


def q_hashtag_summary(spark, sf_dir):
    return _summary(spark, sf_dir)


def q_raw_archive(spark, sf_dir):
    return SP.archive_of_posts(_posts(spark, sf_dir))


def q_stream_speed_layer(spark, sf_dir):
    from tagpulse.streaming.speed_layer import run_speed_layer_on_posts
    result = run_speed_layer_on_posts(prepare(spark), _posts(spark, sf_dir))
    return result.summary()


def q_stream_archive(spark, sf_dir):
    from tagpulse.streaming.speed_layer import run_speed_layer_on_posts
    result = run_speed_layer_on_posts(prepare(spark), _posts(spark, sf_dir))
    return result.archive()


def q_stream_tail(spark, sf_dir):
    from tagpulse.streaming.speed_layer import run_tail_on_posts
    return run_tail_on_posts(prepare(spark), _posts(spark, sf_dir))


# ---- batch layer --------------------------------------------------------------------

def q_english_filter(spark, sf_dir):
    return S.english_by_column(_archive_posts(spark, sf_dir)).select("id", "text")


def q_clean_text(spark, sf_dir):
    return S.clean(S.english_by_column(_archive_posts(spark, sf_dir)).select("id", "text"))


def q_remove_stop_words(spark, sf_dir):
    return _stemmed(spark, sf_dir)


def q_tokenize(spark, sf_dir):
    return S.tokenized(_stemmed(spark, sf_dir)).select("id", "n_tokens", "tokens_text")


def q_polarity_scores(spark, sf_dir):
    return S.score(_stemmed(spark, sf_dir), default_lexicon())


def q_score_join(spark, sf_dir):
    return S.score_by_join(_stemmed(spark, sf_dir), default_lexicon())


def q_polarity_scores_lexicon_join(spark, sf_dir):
    lexicon_df = default_lexicon().to_frame(prepare(spark))
    return S.score_with_lexicon_frame(_stemmed(spark, sf_dir), lexicon_df)


def q_sentiment_label(spark, sf_dir):
    return _sentiment(spark, sf_dir)


def q_scored_tweets(spark, sf_dir):
    return S.scored_tweets(S.score(_stemmed(spark, sf_dir), default_lexicon()))


# ---- serving layer -------------------------------------------------------------------

def q_parse_event_time(spark, sf_dir):
    return _summary(spark, sf_dir).select("_id", "time", parse_event_time("time").alias("timestamp"))


def q_parse_event_time_sql(spark, sf_dir):
    spark = prepare(spark)
    register_sql_function(spark)
    _summary(spark, sf_dir).createOrReplaceTempView("post_summary")
    return spark.sql("SELECT _id, time, toTimestamp(time) AS timestamp FROM post_summary")


def q_summary_by_time(spark, sf_dir):
    return I.summary_by_time(_summary(spark, sf_dir))


def q_hashtag_lookup(spark, sf_dir):
    return I.hashtag_lookup_sql(prepare(spark), _summary(spark, sf_dir), SERVING_HASHTAG)


def q_hashtag_count(spark, sf_dir):
    return I.hashtag_rows(_summary(spark, sf_dir), SERVING_HASHTAG) \
        .agg(F.count(F.lit(1)).alias("n_rows"))


def q_hashtag_preview(spark, sf_dir):
    return I.hashtag_rows(_summary(spark, sf_dir), SERVING_HASHTAG) \
        .orderBy("timestamp", "_id").limit(PREVIEW_ROWS)


def _views(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Summary and sentiment view as serving reads them: ids, hashtags, times and labels, no text.

    Both are columns of the archived posts' narrow rows, which are made in one pass over the texts and stored."""
    tagged = SP.with_hashtag(_posts(spark, sf_dir)).where(F.col("hashtag") != "")
    with more_tasks(spark):
        rows = stored(S.with_labels(tagged, default_lexicon()), "views")
    return SP.summary_rows(rows), rows.where(F.col("sentiment").isNotNull()).select(F.col("id").alias("_id"), "sentiment")


def q_summary_sentiment_join(spark, sf_dir):
    summary, labels = _views(spark, sf_dir)
    return I.join_sentiment(I.with_timestamp(summary), labels) \
        .select("_id", "hashtag", "timestamp", "sentiment")


def q_positive_intervals(spark, sf_dir):
    return I.positive_intervals(*_views(spark, sf_dir), SERVING_HASHTAG)


def q_positive_intervals_all(spark, sf_dir):
    return I.positive_intervals(*_views(spark, sf_dir))


def q_interval_report(spark, sf_dir):
    summary, labels = _views(spark, sf_dir)
    return I.interval_report(summary, stored(I.positive_intervals(summary, labels), "intervals"))


def q_intervals_sql(spark, sf_dir):
    spark = prepare(spark)
    I.register_interval_function(spark, *_views(spark, sf_dir))
    return spark.sql(f"SELECT hashtag, start_ts, end_ts, seconds, tweets FROM {I.INTERVAL_FUNCTION}('{SERVING_HASHTAG}')")


def q_intervals_incremental(spark, sf_dir):
    """The first half of the time, then the second, then what was held back of both; each update touches its own days."""
    summary, labels = _views(spark, sf_dir)
    joined = I.join_sentiment(I.with_timestamp(summary), labels)
    posts = stored(R.labelled_posts(joined), "labelled-posts")
    half = posts.agg((F.min("timestamp") + F.max("timestamp")) / 2).first()[0] or 0
    late = F.pmod(F.col("_id").cast("long"), F.lit(LATE_POSTS)) == 0
    view = R.RunView(spark, scratch_path(spark, "runs"))
    for part in (~late & (F.col("timestamp") < half), ~late & (F.col("timestamp") >= half), late):
        view.update(posts.where(part))
    return view.intervals()


def q_intervals_bucketed(spark, sf_dir):
    """Summary and labels in buckets by id, their join in buckets by hashtag and slice, and the intervals of that."""
    spark = prepare(spark)
    root = scratch_path(spark, "bucketed")
    summary_rows, label_rows = _views(spark, sf_dir)
    summary = B.by_id(I.with_timestamp(summary_rows), f"{root}/summary")
    labels = B.by_id(label_rows, f"{root}/labels")
    return B.intervals(B.by_slice(R.labelled_posts(I.join_sentiment(summary, labels)), f"{root}/labelled"))


def q_stream_sentiment_join(spark, sf_dir):
    """Posts and labels as two streams of files, joined as they arrive."""
    from tagpulse.streaming import sentiment_join as J
    spark = prepare(spark)
    root = scratch_path(spark, "stream-join")
    arrived = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(secs=F.col("_id").cast("long") % 3600)
    for name, rows in zip(("posts", "labels"), _views(spark, sf_dir), strict=True):
        rows.withColumn("arrived", arrived).write.parquet(f"{root}/{name}")
    J.start_join(J.file_stream(spark, f"{root}/posts", J.POSTS), J.file_stream(spark, f"{root}/labels", J.LABELS),
                 f"{root}/joined", f"{root}/checkpoint", "1 hour", available_now=True).awaitTermination()
    return spark.read.schema("_id string, hashtag string, timestamp bigint, sentiment string").parquet(f"{root}/joined")


def q_lexicon_bitset(spark, sf_dir):
    """Scores by a lexicon that stays a table, without a broadcast: what is shuffled passed the lexicon's bit set."""
    lexicon_df = stored(default_lexicon().to_frame(prepare(spark)), "lexicon")
    return S.score_with_lexicon_frame(_stemmed(spark, sf_dir), lexicon_df.hint("merge"))


# ---- keyed and incremental views -----------------------------------------------------

#: Which posts (by their number) arrive late, are replayed, are edited, restored and edited again in the queries of the keyed views.
LATE_POSTS, REPLAYED, EDITED, RESTORED, EDITED_AGAIN = 50, 5, 7, 11, 13
EDIT, LATE_EDIT = "#edited", "#late"


def q_summary_upsert(spark, sf_dir):
    """Two batches (one with replays), merged; an edit, merged; replays of merged batches; restored and edited posts, not merged yet."""
    spark = prepare(spark)
    posts = stored(_summary(spark, sf_dir), "summary")
    number = F.col("_id").cast("long")
    every = lambda n: number % n == 0
    tagged = lambda rows, tag: rows.withColumn("hashtag", F.lit(tag))
    first = posts.where(number % 3 != 2)
    second = posts.where((number % 3 == 2) | every(REPLAYED))
    edits = tagged(posts.where(every(EDITED)), EDIT)
    third = posts.where(every(RESTORED) & ~every(EDITED_AGAIN)).unionByName(tagged(posts.where(every(EDITED_AGAIN)), LATE_EDIT))
    view = KeyedView(spark, scratch_path(spark, "upsert"), SUMMARY)
    view.upsert(first, 0)
    view.upsert(second, 1)
    view.merge()
    view.upsert(edits, 2)
    view.upsert(second, 1)
    view.merge()
    view.upsert(third, 3)
    view.upsert(edits, 2)
    return view.read()


def q_batch_incremental(spark, sf_dir):
    """Two runs of the batch layer: over the first two archive folders, then over a third that holds replays too."""
    spark = prepare(spark)
    root = scratch_path(spark, "increments")
    number = F.col("id").cast("long")
    lines = _archive_posts(spark, sf_dir).select("id", F.to_json(F.struct("id", "text", "created", "lang")).alias("value"))
    increments = SentimentIncrements(spark, f"{root}/archive", f"{root}/sentiment")
    parts = (number % 2 == 0, number % 4 == 1, (number % 4 == 3) | (number % (2 * REPLAYED) == 0))
    for runs in ((0, 1), (2,)):
        for batch in runs:
            write_archive(lines.where(parts[batch]), increments.archive, batch)
        increments.run(lambda new: sentiment_of_lines(new, default_lexicon(), lang_column=True))
    return increments.read()


def q_stream_rejected(spark, sf_dir):
    """The records that the stream can't use, of a stream in which every fifth is damaged in one of four ways."""
    from tagpulse.streaming.speed_layer import run_speed_layer
    spark = prepare(spark)
    kind = F.col("id").cast("long") % 20
    value = (F.when(kind == 3, F.concat(F.lit("no json "), "id")).when(kind == 7, F.to_json(F.struct("id", "created")))
             .when(kind == 11, F.to_json(F.struct("text", "created"))).when(kind == 13, F.lit(None).cast("string"))
             .otherwise(F.to_json(F.struct("id", "text", "created"))))
    records = _posts(spark, sf_dir).select(F.col("id").alias("key"), value.alias("value"))
    return run_speed_layer(spark, records, with_rejected=True).rejected()


def q_archive_day(spark, sf_dir):
    """The archived lines of the first day, from an archive in folders by date."""
    from tagpulse.streaming.speed_layer import run_speed_layer
    spark = prepare(spark)
    archive = run_speed_layer(spark, SP.to_records(_posts(spark, sf_dir)), by_day=True).archive_path
    days = read_archive_days(spark, archive)
    day = days.agg(F.min("date")).first()[0]
    return days.where(F.col("date") == F.lit(day)).select("value", F.col("date").cast("string").alias("date"))


# ---- language identification ---------------------------------------------------------

def _documents(spark, sf_dir):
    return spread(read_table(prepare(spark), sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id")


def _profiles(spark, sf_dir):
    return L.train_profiles(_documents(spark, sf_dir))


def _detected(spark, sf_dir, archive):
    return L.detect(archive, _profiles(spark, sf_dir), L.training_vocabulary(_documents(spark, sf_dir)))


def q_language_profiles(spark, sf_dir):
    return _profiles(spark, sf_dir)


def q_detect_language(spark, sf_dir):
    archive = _archive_posts(spark, sf_dir).select("id", "text")
    return _detected(spark, sf_dir, archive)


def _language_model(spark, sf_dir):
    """A model trained on the labelled documents, stored, and read back."""
    path = scratch_path(prepare(spark), "language-model")
    LM.save(spark, path, _documents(spark, sf_dir))
    return LM.load(spark, path)


def q_sentiment_label_detected(spark, sf_dir):
    # Detection and labelling both read the archive: it is made once, with what detection needs.
    archive = _archive_posts(spark, sf_dir).select("id", "text")
    english = L.english_texts(archive, _profiles(spark, sf_dir), L.training_vocabulary(_documents(spark, sf_dir)))
    return S.sentiment_view(english.withColumn("lang", F.lit(S.ENGLISH)), default_lexicon())


def q_stream_english(spark, sf_dir):
    """The English posts as the speed layer writes them, a micro-batch at a time, by the stored model."""
    from tagpulse.streaming.speed_layer import run_speed_layer
    spark = prepare(spark)
    return run_speed_layer(spark, SP.to_records(_posts(spark, sf_dir)), model=_language_model(spark, sf_dir)).english()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ingest_normalize": q_ingest_normalize,
    "publish_payload": q_publish_payload,
    "parse_raw_json": q_parse_raw_json,
    "tail_texts": q_tail_texts,
    "hashtag_extract": q_hashtag_extract,
    "hashtag_summary": q_hashtag_summary,
    "raw_archive": q_raw_archive,
    "stream_speed_layer": q_stream_speed_layer,
    "stream_archive": q_stream_archive,
    "stream_tail": q_stream_tail,
    "english_filter": q_english_filter,
    "clean_text": q_clean_text,
    "remove_stop_words": q_remove_stop_words,
    "tokenize": q_tokenize,
    "polarity_scores": q_polarity_scores,
    "score_join": q_score_join,
    "polarity_scores_lexicon_join": q_polarity_scores_lexicon_join,
    "sentiment_label": q_sentiment_label,
    "scored_tweets": q_scored_tweets,
    "parse_event_time": q_parse_event_time,
    "parse_event_time_sql": q_parse_event_time_sql,
    "summary_by_time": q_summary_by_time,
    "hashtag_lookup": q_hashtag_lookup,
    "hashtag_count": q_hashtag_count,
    "hashtag_preview": q_hashtag_preview,
    "summary_sentiment_join": q_summary_sentiment_join,
    "positive_intervals": q_positive_intervals,
    "positive_intervals_all": q_positive_intervals_all,
    "interval_report": q_interval_report,
    "intervals_sql": q_intervals_sql,
    "intervals_incremental": q_intervals_incremental,
    "intervals_bucketed": q_intervals_bucketed,
    "stream_sentiment_join": q_stream_sentiment_join,
    "lexicon_bitset": q_lexicon_bitset,
    "summary_upsert": q_summary_upsert,
    "batch_incremental": q_batch_incremental,
    "stream_rejected": q_stream_rejected,
    "archive_day": q_archive_day,
    "language_profiles": q_language_profiles,
    "detect_language": q_detect_language,
    "sentiment_label_detected": q_sentiment_label_detected,
    "stream_english": q_stream_english,
}
