"""Fixed schemas of every relation the layers exchange."""

from pyspark.sql.types import FloatType, LongType, StringType, StructField, StructType

# Kafka-shaped record: key = post id, value = JSON text of a raw post.
RECORD = StructType([
    StructField("key", StringType()),
    StructField("value", StringType()),
])

# Raw post as published by the ingest side; ``id`` may arrive as a JSON number.
RAW_POST = StructType([
    StructField("id", StringType()),
    StructField("text", StringType()),
    StructField("created", StringType()),
])

# Speed-layer view: first hashtag of a post and its creation time string.
SUMMARY = StructType([
    StructField("_id", StringType()),
    StructField("hashtag", StringType()),
    StructField("time", StringType()),
])

# Batch-layer view: stop-word-free text and its label.
SENTIMENT = StructType([
    StructField("_id", StringType()),
    StructField("text", StringType()),
    StructField("sentiment", StringType()),
])

SCORED = StructType([
    StructField("id", StringType()),
    StructField("text", StringType()),
    StructField("pos_score", FloatType()),
    StructField("neg_score", FloatType()),
    StructField("type", StringType()),
])

LEXICON = StructType([
    StructField("word", StringType()),
    StructField("category", StringType()),
])

INTERVAL = StructType([
    StructField("hashtag", StringType()),
    StructField("start_ts", LongType()),
    StructField("end_ts", LongType()),
    StructField("seconds", LongType()),
    StructField("tweets", LongType()),
])
