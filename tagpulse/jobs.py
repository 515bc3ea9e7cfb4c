"""The jobs: ingest, stream tail, speed layer, batch layer, serving layer, upkeep.

    python -m tagpulse.jobs ingest  --posts DIR [--posts-format json] [--stream] SINK
    python -m tagpulse.jobs tail    SOURCE
    python -m tagpulse.jobs learn   --labelled PARQUET --model DIR
    python -m tagpulse.jobs speed   SOURCE --views DIR [--once] [--dedupe-delay "1 hour"] [--model DIR]
    python -m tagpulse.jobs batch   --views DIR [--increment] ENGLISH LEXICON
    python -m tagpulse.jobs serve   --views DIR HASHTAG
    python -m tagpulse.jobs compact --views DIR

SOURCE and SINK are ``--records DIR [--format parquet]`` or ``--format kafka --option
kafka.bootstrap.servers=HOST:PORT --option subscribe=TOPIC`` (``topic=TOPIC`` for a sink); other
``--option key=value`` pairs go to the reader or writer too.  ENGLISH says which posts count
as English: ``--labelled PARQUET`` (``text, lang``: detect), ``--model DIR`` (detect by the model that ``learn`` stored), ``--lang-column`` (the archive's lines have a
``lang`` field) or ``--all-english``.  LEXICON is ``--lexicon STOP POSITIVE NEGATIVE`` or ``--packaged-lexicon``.

``--increment`` reads only the archive folders that no increment before has read.
``--views`` holds ``summary/``, ``archive/``, ``rejected/``, ``english/`` (with a model), ``sentiment/`` or ``increments/`` and the stream
checkpoint.  Results are DataFrames; only ``serve`` prints, streaming its rows
to the driver one partition at a time.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.functions.lexicon import Lexicon, LexiconTable, default_lexicon, load_lexicon
from tagpulse.operators import intervals as I
from tagpulse.operators import language as L
from tagpulse.operators import language_model as LM
from tagpulse.operators import sentiment as S
from tagpulse.operators.speed import parse_records, to_records
from tagpulse.schemas import RAW_POST
from tagpulse.session import delete_scratch, get_session, prepare, stored
from tagpulse.sinks.increments import SentimentIncrements
from tagpulse.sinks.writers import publish_records, show, write_view
from tagpulse.sources.posts import normalize_posts
from tagpulse.sources.views import read_sentiment_view, summary_view
from tagpulse.streaming.speed_layer import MICRO_BATCH, record_stream, start_speed_layer, start_tail


def layout(views: str) -> dict[str, str]:
    views = views.rstrip("/")
    return {name: f"{views}/{name}" for name in ("summary", "archive", "sentiment", "increments", "rejected", "english", "checkpoint", "ingest_checkpoint")}


def ingest(spark: SparkSession, posts: str, records: str | None, posts_fmt: str = "json", fmt: str = "parquet",
           options: dict | None = None, stream: bool = False, checkpoint: str | None = None, once: bool = False):
    """P1 + K1: raw posts (files of ``id, text, created``) -> normalised records, once or as a stream."""
    if not stream:
        raw = spark.read.schema(RAW_POST).format(posts_fmt).load(posts)
        publish_records(to_records(normalize_posts(raw)), records, fmt, options)
        return None
    raw = spark.readStream.schema(RAW_POST).format(posts_fmt).load(posts)
    writer = to_records(normalize_posts(raw)).writeStream.format(fmt).options(**(options or {})) \
        .option("checkpointLocation", checkpoint or f"{records}-checkpoint")
    if fmt != "kafka":
        writer = writer.option("path", records)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=MICRO_BATCH)
    return writer.start()


def tail(spark: SparkSession, records: str | None, fmt: str = "parquet", options: dict | None = None,
         timeout_s: float | None = None) -> None:
    """Print the text of every incoming record."""
    query = start_tail(record_stream(spark, fmt, records, options))
    query.awaitTermination(timeout_s)


def speed(spark: SparkSession, records: str | None, views: str, fmt: str = "parquet",
          options: dict | None = None, once: bool = False, echo: bool = False,
          timeout_s: float | None = None, dedupe_delay: str | None = None, model: str | None = None):
    """Summary view, raw archive, rejected records and (with a stored language model) English posts from the record stream."""
    paths = layout(views)
    query = start_speed_layer(record_stream(spark, fmt, records, options), paths["summary"],
                              paths["archive"], paths["checkpoint"], available_now=once, echo=echo, dedupe_delay=dedupe_delay,
                              rejected_path=paths["rejected"], model=LM.load(spark, model) if model else None,
                              english_path=paths["english"] if model else None)
    query.awaitTermination(timeout_s)
    return query


def batch(spark: SparkSession, views: str, lexicon: Lexicon | LexiconTable, labelled: DataFrame | None = None,
          lang_column: bool = False, all_english: bool = False, model: str | None = None) -> DataFrame:
    """Archive -> English posts -> sentiment view.

    Exactly one of ``labelled`` (detect English with trigram profiles trained on its
    ``text, lang``), ``model`` (detect with the profiles stored there), ``lang_column`` (read the lines' ``lang`` field) and
    ``all_english`` must be given: the original always filters on English."""
    _one_english(labelled, lang_column, all_english, model)
    paths = layout(views)
    lines = spark.read.text(paths["archive"]).select("value")
    write_view(sentiment_of_lines(lines, lexicon, labelled, lang_column, LM.load(spark, model) if model else None), paths["sentiment"])
    return read_sentiment_view(spark, paths["sentiment"])


def _one_english(labelled: DataFrame | None, lang_column: bool, all_english: bool, model: str | None) -> None:
    if (labelled is not None) + lang_column + all_english + (model is not None) != 1:
        raise ValueError("say which posts are English: labelled, model, lang_column or all_english")


def learn(spark: SparkSession, labelled: DataFrame, model: str) -> int:
    """Language profiles of labelled texts as the newest version of the model stored at ``model``."""
    return LM.save(spark, model.rstrip("/"), labelled.select("text", "lang"))


def sentiment_of_lines(lines: DataFrame, lexicon: Lexicon | LexiconTable, labelled: DataFrame | None = None, lang_column: bool = False,
                       model: LM.LanguageModel | None = None) -> DataFrame:
    """``_id, text, sentiment`` of archived lines (``value``): English by detection, by their ``lang`` field, or all."""
    if model is not None:
        return S.sentiment_view(model.english(parse_records(lines)).withColumn("lang", F.lit(S.ENGLISH)), lexicon)
    if labelled is not None:
        archive, labelled = parse_records(lines), labelled.select("text", "lang")
        english = L.english_ids(L.detect(archive.select("id", "text"), L.train_profiles(labelled), L.training_vocabulary(labelled)))
        return S.sentiment_view(archive, lexicon, english=english)
    if lang_column:
        posts = lines.select(F.from_json("value", "id STRING, text STRING, lang STRING").alias("p")).select("p.*")
        return S.sentiment_view(posts.where("id is not null and text is not null"), lexicon)
    return S.sentiment_view(parse_records(lines).withColumn("lang", F.lit(S.ENGLISH)), lexicon)


def batch_increment(spark: SparkSession, views: str, lexicon: Lexicon | LexiconTable, labelled: DataFrame | None = None,
                    lang_column: bool = False, all_english: bool = False, model: str | None = None) -> list[int]:
    """E3 for what is new: the archive's folders that no increment has read; returns their batch numbers."""
    _one_english(labelled, lang_column, all_english, model)
    paths = layout(views)
    stored_model = LM.load(spark, model) if model else None
    increments = SentimentIncrements(spark, paths["archive"], paths["increments"])
    return increments.run(lambda lines: sentiment_of_lines(lines, lexicon, labelled, lang_column, stored_model))


def sentiment(spark: SparkSession, views: str) -> DataFrame:
    """The sentiment view of the increments if there are any, else of the last full batch."""
    paths = layout(views)
    increments = SentimentIncrements(spark, paths["archive"], paths["increments"])
    return increments.read() if increments.exists() else read_sentiment_view(spark, paths["sentiment"])


def serve_frames(spark: SparkSession, views: str, hashtag: str | None):
    """The stored, time-stamped rows of a hashtag (of all, if None) and their intervals, lazily."""
    paths = layout(views)
    where = None if hashtag is None else F.col("hashtag") == F.lit(hashtag)
    summary = stored(summary_view(spark, paths["summary"]).read(where), "serve")
    return summary, lambda: I.positive_intervals(summary, sentiment(spark, views))


def serve(spark: SparkSession, views: str, hashtag: str, out=sys.stdout) -> DataFrame | None:
    """Print the hashtag's rows and its intervals like the original.

    The views are scanned for one hashtag, once; without rows nothing else runs."""
    summary, intervals = serve_frames(spark, views, hashtag)
    if summary.isEmpty():
        print(I.no_hashtag_message(hashtag), file=out)
        return None
    show(I.with_timestamp(summary).select("_id", "hashtag", "timestamp").orderBy("timestamp", "_id"))
    found = stored(intervals(), "served")
    printed = 0
    for row in found.orderBy("start_ts").toLocalIterator():
        print(I.INTERVAL_MESSAGE % (row["hashtag"], row["seconds"], row["tweets"]), file=out)
        printed += 1
    if printed == 0:
        print(I.NO_INTERVALS_MESSAGE, file=out)
    return found


def compact(spark: SparkSession, views: str) -> int | None:
    """Upkeep: the summary's micro-batches, and the batch layer's increments, go into their keyed bases."""
    paths = layout(views)
    SentimentIncrements(spark, paths["archive"], paths["increments"]).compact()
    return summary_view(spark, paths["summary"]).merge()


def _pairs(values: list[str] | None) -> dict[str, str]:
    pairs = [v.partition("=") for v in values or ()]
    if any(not sep for _, sep, _ in pairs):
        raise SystemExit("--option takes key=value")
    return {k: v for k, _, v in pairs}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tagpulse.jobs")
    sub = top.add_subparsers(dest="job", required=True)

    def records(p: argparse.ArgumentParser) -> None:
        p.add_argument("--records", help="folder of record files")
        p.add_argument("--format", default="parquet")
        p.add_argument("--option", action="append", metavar="KEY=VALUE")

    p = sub.add_parser("ingest")
    p.add_argument("--posts", required=True, help="raw posts: id, text, created")
    p.add_argument("--posts-format", default="json")
    p.add_argument("--stream", action="store_true")
    p.add_argument("--once", action="store_true")
    p.add_argument("--checkpoint")
    records(p)
    p = sub.add_parser("tail")
    records(p)
    p = sub.add_parser("learn")
    p.add_argument("--labelled", required=True, help="parquet with text, lang")
    p.add_argument("--model", required=True, help="folder of the stored language model")
    p = sub.add_parser("speed")
    p.add_argument("--views", required=True)
    p.add_argument("--once", action="store_true")
    p.add_argument("--dedupe-delay")
    p.add_argument("--model", help="folder of a stored language model")
    records(p)
    p = sub.add_parser("batch")
    p.add_argument("--views", required=True)
    p.add_argument("--increment", action="store_true")
    english = p.add_mutually_exclusive_group(required=True)
    english.add_argument("--labelled", help="parquet with text, lang for language profiles")
    english.add_argument("--model", help="folder of a stored language model")
    english.add_argument("--lang-column", action="store_true")
    english.add_argument("--all-english", action="store_true")
    words = p.add_mutually_exclusive_group(required=True)
    words.add_argument("--lexicon", nargs=3, metavar=("STOP", "POSITIVE", "NEGATIVE"))
    words.add_argument("--packaged-lexicon", action="store_true")
    p = sub.add_parser("serve")
    p.add_argument("--views", required=True)
    p.add_argument("hashtag")
    p = sub.add_parser("compact")
    p.add_argument("--views", required=True)
    return top


def checked(args: argparse.Namespace) -> dict[str, str]:
    """The reader's or writer's options; an incomplete source or sink is refused before Spark starts."""
    options = _pairs(args.option)
    if args.format == "kafka":
        if "kafka.bootstrap.servers" not in options:
            raise SystemExit("--format kafka needs --option kafka.bootstrap.servers=HOST:PORT")
        if args.job == "ingest" and "topic" not in options:
            raise SystemExit("--format kafka needs --option topic=TOPIC to publish")
    elif not args.records:
        raise SystemExit("--records is needed for file formats")
    return options


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    options = checked(args) if hasattr(args, "format") else {}
    spark = prepare(get_session())
    if args.job == "ingest":
        query = ingest(spark, args.posts, args.records, args.posts_format, args.format, options, args.stream, args.checkpoint, args.once)
        if query is not None:
            query.awaitTermination()
    elif args.job == "tail":
        tail(spark, args.records, args.format, options)
    elif args.job == "learn":
        learn(spark, spark.read.parquet(args.labelled), args.model)
        delete_scratch(spark)
    elif args.job == "speed":
        speed(spark, args.records, args.views, args.format, options, once=args.once, echo=True, dedupe_delay=args.dedupe_delay, model=args.model)
    elif args.job == "batch":
        labelled = spark.read.parquet(args.labelled) if args.labelled else None
        lexicon = load_lexicon(spark, *args.lexicon) if args.lexicon else default_lexicon()
        (batch_increment if args.increment else batch)(spark, args.views, lexicon, labelled, args.lang_column, args.all_english, args.model)
        delete_scratch(spark)
    elif args.job == "serve":
        serve(spark, args.views, args.hashtag)
        delete_scratch(spark)
    else:
        compact(spark, args.views)
    return 0


if __name__ == "__main__":
    sys.exit(main())
