"""Bucketed views, joined streams, bit sets of a lexicon: what moves and what is remembered."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tagpulse.functions.lexicon import Lexicon, word_bits
from tagpulse.operators import intervals as I
from tagpulse.operators import runs as R
from tagpulse.operators import sentiment as S
from tagpulse.session import scratch_path
from tagpulse.sinks import bucketed as B
from tagpulse.streaming import sentiment_join as J
from tests.test_runs import POSTS, brute, posts, seen


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", [1, 2])
def test_bucketed_intervals_move_no_post(spark, seed):
    rows = posts(seed)
    table = B.by_slice(spark.createDataFrame(rows, POSTS), scratch_path(spark, "sliced"), buckets=4)
    found = B.intervals(table)
    assert seen(found) == brute(rows)
    # Before the first exchange of each branch the posts have become runs: they are windowed and aggregated where they lie.
    plan = plan_of(found).split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "FileScan" in line and "Bucketed: true" in line:
            above = lines[:i][::-1]
            upto = next(k for k, x in enumerate(above) if re.search(r"\bExchange\b|ShuffleQueryStage|AQEShuffleRead", x))
            assert any("Window" in x for x in above[:upto]) and any("HashAggregate" in x for x in above[:upto])
    assert "Bucketed: true" in plan


def test_views_in_buckets_by_id_join_without_an_exchange(spark):
    root = scratch_path(spark, "by-id")
    left = B.by_id(spark.createDataFrame([(str(i), f"#{i % 3}", i) for i in range(200)], "_id string, hashtag string, timestamp long"), f"{root}/a", 4)
    right = B.by_id(spark.createDataFrame([(str(i), "positive") for i in range(0, 200, 2)], "_id string, sentiment string"), f"{root}/b", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = I.join_sentiment(left, right)
        plan = plan_of(joined)
        assert joined.count() == 100 and "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def drain(spark, root, name="q"):
    query = J.start_join(J.file_stream(spark, f"{root}/posts", J.POSTS), J.file_stream(spark, f"{root}/labels", J.LABELS),
                         f"{root}/joined", f"{root}/checkpoint", "1 hour", available_now=True)
    query.awaitTermination()
    return query


def test_streams_join_as_they_arrive_and_state_stays_bounded(spark):
    root = scratch_path(spark, "stream-join")
    at = lambda hour: F.lit(f"2024-01-01 {hour:02d}:00:00").cast("timestamp")

    def post(ids, hour):
        spark.createDataFrame([(i, "#a", "Mon Jan 01 000001 UTC 2024") for i in ids], "_id string, hashtag string, time string") \
            .withColumn("arrived", at(hour)).write.mode("append").parquet(f"{root}/posts")

    def label(ids, hour):
        spark.createDataFrame([(i, "positive") for i in ids], "_id string, sentiment string").withColumn("arrived", at(hour)).write.mode("append").parquet(f"{root}/labels")

    post([f"a{i}" for i in range(50)], 0)
    label(["a1", "a2", "a2"], 0)
    drain(spark, root)
    state = []
    for hour in (4, 8, 12, 16):
        post([f"{hour}-{i}" for i in range(50)], hour)
        label([f"{hour}-1", "a1", f"{hour - 4}-7" if hour > 4 else "a7"], hour)  # the last one too late, a1 again
        query = drain(spark, root)
        state.append(sum(s.numRowsTotal for p in query.recentProgress[-1:] for s in p.stateOperators))
    got = sorted(r["_id"] for r in spark.read.parquet(f"{root}/joined").collect())
    assert got == sorted(["a1", "a2", "4-1", "8-1", "12-1", "16-1"])
    assert max(state) <= 4 * 60 and state[-1] <= state[0] + 10  # what arrived lately, not what ever arrived


def test_bit_sets_hold_every_word_and_little_else(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 12)))
    inside = {word() for _ in range(5000)}
    outside = {word() for _ in range(30000)} - inside
    bits = word_bits(spark.createDataFrame([(w,) for w in inside], "word string"))
    asked = spark.createDataFrame([(w, w in inside) for w in inside | outside], "word string, inside boolean")
    passed = dict(map(tuple, asked.where(bits.may_hold(F.col("word"))).groupBy("inside").count().collect()))
    assert passed[True] == len(inside) and passed.get(False, 0) < 0.002 * len(outside)
    assert word_bits(spark.createDataFrame([], "word string")).bits == 64


def test_few_tokens_are_shuffled_without_a_broadcast(spark):
    """Tokens that reach the join: the hits and at most 2 in 100 more."""
    rng = random.Random(8)
    lexicon = Lexicon(stop=(), positive=frozenset(f"good{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(100)), negative=frozenset({"bad"}))
    words = [*sorted(lexicon.positive), *[f"plain{'abcdefghijklmnop'[i % 16]}{'qrstuvwxyz'[i // 16 % 10]}" for i in range(160)]]
    rows = [(str(i), " ".join(rng.choice(words) for _ in range(60))) for i in range(300)]
    frame = spark.createDataFrame(rows, "id string, text string")
    hits = sum(w in lexicon.positive for _, t in rows for w in t.split())
    bits = word_bits(lexicon.to_frame(spark).select("word"))
    tokens = frame.select(F.explode(F.filter(F.split("text", " "), bits.may_hold)).alias("w")).count()
    assert hits <= tokens <= 1.02 * hits
    cols = ["id", "text", "n_tokens", "pos_hits", "neg_hits", "pos_score", "neg_score"]
    a = sorted(map(tuple, S.score(frame, lexicon).select(cols).collect()))
    b = sorted(map(tuple, S.score_with_lexicon_frame(frame, lexicon.to_frame(spark).hint("merge")).select(cols).collect()))
    assert a == b


def test_fold_of_slices_keeps_the_order_of_untimed_posts(spark):
    rows = [("#a", 0, "10", 0), ("#a", 0, "2", 1), ("#a", 5, "1", 1), ("#a", 0, "1", 0), ("#a", -7, "9", 0)]
    assert seen(B.intervals(B.by_slice(spark.createDataFrame(rows, POSTS), scratch_path(spark, "sliced"), 2))) == brute(rows)
    assert R.SLICE_SECONDS == 3600
