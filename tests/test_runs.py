"""Run summaries: any cuts, any order of arrival, the same intervals."""

import random

import pytest
from pyspark.sql import functions as F

from tagpulse.operators import runs as R
from tagpulse.session import scratch_path
from tests.models import intervals_state_machine

POSTS = "hashtag string, timestamp long, _id string, np long"


def posts(seed, n=500, tags=4, span=200_000):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        tag = "#hot" if rng.random() < 0.5 else f"#t{rng.randrange(tags)}"
        ts = 0 if rng.random() < 0.2 else rng.choice([rng.randrange(1, span), rng.randrange(1, 20), -rng.randrange(1, 9000)])
        out.append((tag, ts, f"{rng.randrange(10**6)}x{k}", int(rng.random() < 0.4)))
    return out


def brute(rows):
    out = []
    for tag in {r[0] for r in rows}:
        mine = [(ts, i, "negative" if np else "positive") for h, ts, i, np in rows if h == tag]
        out += [(tag, *r) for r in intervals_state_machine(mine)]
    return sorted(out)


def seen(df):
    return sorted(map(tuple, df.select("hashtag", "start_ts", "end_ts", "seconds", "tweets").collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_folding_is_associative(spark, seed):
    """One fold of all posts, and folds of random neighbours in two other shapes."""
    rng = random.Random(seed)
    rows = posts(seed, 300)
    ordered = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    cut = lambda n: sorted(rng.randrange(len(rows)) for _ in range(n))
    small, large = cut(40), cut(6)
    of = lambda cuts, k: sum(c <= k for c in cuts)
    frame = spark.createDataFrame([(*r, k, of(large, k), of(large, k) * 100 + of(small, k)) for k, r in enumerate(ordered)], f"{POSTS}, k int, large int, small int")
    units = R.posts_as_runs(frame)

    def closed(parts, whole):
        lead = whole.where("end is not null and lead_n > 0").selectExpr("hashtag", "lead_start as start_ts", "end as end_ts", "lead_n as tweets")
        found = [tuple(r) for p in [*parts, lead] for r in p.select("hashtag", "start_ts", "end_ts", "tweets").collect()]
        return sorted((h, a, b, b - a, n) for h, a, b, n in found)

    once, whole = R.fold(units, [], ["k"])
    want = brute(rows)
    assert closed([once], whole) == want
    a, small_runs = R.fold(units, ["large", "small"], ["k"])
    b, large_runs = R.fold(small_runs, ["large"], ["small"])
    c, whole = R.fold(large_runs, [], ["large"])
    assert closed([a, b, c], whole) == want
    b, whole = R.fold(small_runs, [], ["large", "small"])
    assert closed([a, b], whole) == want


@pytest.mark.parametrize("seed", [3, 4])
def test_updates_in_any_order_equal_the_state_machine(spark, seed):
    rng = random.Random(seed)
    rows = posts(seed)
    rng.shuffle(rows)
    view = R.RunView(spark, scratch_path(spark, "runs"), pieces=7)
    assert view.intervals().count() == 0
    done = []
    for lo in range(0, len(rows), 170):
        part = rows[lo:lo + 170]
        done += part
        replayed = part + rng.sample(done, 5)
        view.update(spark.createDataFrame(replayed, POSTS))
        assert seen(view.intervals()) == brute(done)
    assert view.update(spark.createDataFrame([], POSTS)) == []


def test_an_update_touches_its_own_days_only(spark):
    view = R.RunView(spark, scratch_path(spark, "runs"))
    day = R.DAY_SECONDS
    view.update(spark.createDataFrame([("#a", d * day + k, f"{d}-{k}", k % 2) for d in range(5) for k in range(4)], POSTS))
    before = view._state()[1]["posts"]
    touched = view.update(spark.createDataFrame([("#a", 2 * day + 9, "late", 1), ("#a", 0, "77", 1)], POSTS))
    after = view._state()[1]["posts"]
    assert touched == ["day=0/part=3737", "day=3/part=t"]
    assert {s: v for s, v in after.items() if s not in touched} == {s: v for s, v in before.items() if s not in touched}
    assert all(after[s] == 1 for s in touched)


def test_a_hot_second_of_a_hot_hashtag_is_many_stretches(spark):
    rng = random.Random(5)
    rows = [("#hot", 3600, f"{k:05d}", int(rng.random() < 0.5)) for k in range(2000)]
    view = R.RunView(spark, scratch_path(spark, "runs"), pieces=8)
    view.update(spark.createDataFrame(rows, POSTS))
    sizes = view._read("posts", view._state()[1]["posts"]).groupBy("hashtag", "slice", "piece").count()
    assert sizes.count() == 8 and sizes.agg(F.max("count")).first()[0] <= 500
    assert seen(view.intervals()) == brute(rows)


def test_a_post_that_comes_again_replaces_its_row(spark):
    view = R.RunView(spark, scratch_path(spark, "runs"))
    view.update(spark.createDataFrame([("#a", 10, "1", 0), ("#a", 20, "2", 1)], POSTS))
    assert seen(view.intervals()) == [("#a", 10, 20, 10, 1)]
    view.update(spark.createDataFrame([("#a", 10, "1", 1)], POSTS))
    assert seen(view.intervals()) == []
