"""Keyed views: upserts, replays, merges that leave untouched files alone, increments that survive a crash."""

import random

import pytest
from pyspark.sql import functions as F

from tagpulse import jobs
from tagpulse.functions.lexicon import default_lexicon
from tagpulse.schemas import SUMMARY
from tagpulse.session import scratch_path
from tagpulse.sinks import increments as INC
from tagpulse.sinks import manifest
from tagpulse.sinks import writers as W
from tagpulse.sinks.keyed import SMALLEST, KeyedView
from tagpulse.sources.views import read_summary_view


def rows(spark, *posts):
    return spark.createDataFrame([(i, h, t) for i, h, t in posts], SUMMARY)


def files(spark, view):
    base = view._base(view._state()[1])
    return set(base.inputFiles())


def seen(df):
    return sorted(map(tuple, df.select(*SUMMARY.names).collect()))


def test_later_batches_win_and_replays_change_nothing(spark):
    view = KeyedView(spark, scratch_path(spark, "keyed"), SUMMARY, buckets=4)
    assert view.read().count() == 0 and view.merge() is None
    view.upsert(rows(spark, ("1", "#a", "x"), ("2", "#b", "x"), ("2", "#b", "x"), (None, "#n", "x")), 0)
    assert seen(view.read()) == [("1", "#a", "x"), ("2", "#b", "x")]
    assert view.merge() == 0
    edit = rows(spark, ("2", "#c", "x"), ("3", "#b", "x"))
    view.upsert(edit, 1)
    view.upsert(edit, 1)
    view.upsert(rows(spark, ("1", "#old", "x")), 0)  # the merged batch runs again
    want = [("1", "#a", "x"), ("2", "#c", "x"), ("3", "#b", "x")]
    assert seen(view.read()) == want
    assert view.merge() == 1 and seen(view.read()) == want and view.merge() == 1
    assert seen(view.read(F.col("hashtag") == "#b")) == [("3", "#b", "x")]


def test_a_post_has_one_row_whatever_its_tags(spark):
    """A changed tag, asked for by the old and by the new tag, before and after the merge."""
    view = KeyedView(spark, scratch_path(spark, "keyed"), SUMMARY, buckets=2)
    view.upsert(rows(spark, ("1", "#a", "x"), ("2", "#a", "x")), 0)
    view.merge()
    view.upsert(rows(spark, ("1", "#b", "x")), 1)
    for _ in range(2):
        assert [r["_id"] for r in view.read(F.col("hashtag") == "#a").collect()] == ["2"]
        assert [r["_id"] for r in view.read(F.col("hashtag") == "#b").collect()] == ["1"]
        view.merge()


def test_a_merge_rewrites_only_touched_buckets(spark):
    view = KeyedView(spark, scratch_path(spark, "keyed"), SUMMARY, buckets=8)
    view.upsert(rows(spark, *[(str(i), f"#t{i % 5}", "x") for i in range(400)]), 0)
    view.merge()
    before = files(spark, view)
    view.upsert(rows(spark, ("7", "#new", "x")), 1)
    view.merge()
    after = files(spark, view)
    gone = before - after
    assert len(gone) == 1 and len(before & after) == len(before) - 1  # the others keep their names
    (bucket,) = {f.split("bucket=")[1].split("/")[0] for f in gone}
    assert bucket == str(spark.range(1).select(F.pmod(F.xxhash64(F.lit("7")), F.lit(8))).first()[0])
    assert view.read().count() == 400 and seen(view.read(F.col("hashtag") == "#new")) == [("7", "#new", "x")]


def test_a_running_reader_keeps_its_files(spark):
    view = KeyedView(spark, scratch_path(spark, "keyed"), SUMMARY, buckets=2)
    view.upsert(rows(spark, ("1", "#a", "x")), 0)
    view.merge()
    view.upsert(rows(spark, ("2", "#b", "x")), 1)
    reader = view.read()
    view.merge()
    assert seen(reader) == [("1", "#a", "x"), ("2", "#b", "x")] == seen(view.read())


def test_buckets_double_when_they_have_grown(spark):
    view = KeyedView(spark, scratch_path(spark, "keyed"), SUMMARY, buckets=1, bucket_bytes=1000)
    want = {}
    for batch in range(4):
        posts = [(f"{batch % 2}-{i}", f"#{batch}", "x" * 5) for i in range(200)]
        want.update({p[0]: p for p in posts})
        view.upsert(rows(spark, *posts), batch)
        view.merge()
    assert view._state()[1]["buckets"] == 8
    assert seen(view.read()) == sorted(want.values())


def test_a_second_merge_of_the_same_version_fails(spark):
    path = scratch_path(spark, "manifest")
    manifest.commit(spark, path, 0, {"a": 1})
    with pytest.raises(Exception, match="(?i)exist"):  # noqa: B017
        manifest.commit(spark, path, 0, {"a": 2})
    assert manifest.read(spark, path) == (0, {"a": 1})


@pytest.mark.parametrize("prefer", ["latest", SMALLEST])
def test_any_history_equals_a_dictionary(spark, prefer):
    rng = random.Random(len(prefer))
    view = KeyedView(spark, scratch_path(spark, "keyed"), SUMMARY, prefer=prefer, buckets=3, bucket_bytes=4000)
    want = {}
    for batch in range(6):
        posts = {str(rng.randrange(40)): (f"#{rng.randrange(9)}", str(batch)) for _ in range(15)}
        for i, value in posts.items():
            want[i] = value if prefer == "latest" or i not in want else min(want[i], value)
        view.upsert(rows(spark, *[(i, *v) for i, v in posts.items()]), batch)
        if rng.random() < 0.4:
            view.merge()
    assert seen(view.read()) == sorted((i, *v) for i, v in want.items())


def test_plain_batches_have_one_row_per_post(spark):
    root = scratch_path(spark, "plain")
    W.write_batch_view(rows(spark, ("1", "#a", "x"), ("2", "#a", "x")), root, 0)
    W.write_batch_view(rows(spark, ("1", "#b", "y"), ("3", "#b", "y")), root, 1)
    assert seen(read_summary_view(spark, root)) == [("1", "#a", "x"), ("2", "#a", "x"), ("3", "#b", "y")]
    assert seen(read_summary_view(spark, root, "#a")) == [("1", "#a", "x"), ("2", "#a", "x")]
    assert seen(read_summary_view(spark, root, "#b")) == [("3", "#b", "y")]


# --- increments -----------------------------------------------------------------

def lines(spark, *posts):
    text = [(f'{{"id": "{i}", "text": "{t}", "created": "x", "lang": "en"}}',) for i, t in posts]
    return spark.createDataFrame(text, "value string")


def run(increments, asked=None):
    def sentiment(new):
        if asked is not None:
            asked.append({f.split("batch_id=")[1].split("/")[0] for f in new.inputFiles()})
        return jobs.sentiment_of_lines(new, default_lexicon(), lang_column=True)
    return increments.run(sentiment)


def test_an_increment_reads_new_folders_only(spark):
    root = scratch_path(spark, "increments")
    inc, asked = INC.SentimentIncrements(spark, f"{root}/archive", f"{root}/sentiment"), []
    assert run(inc, asked) == [] and not inc.exists()
    W.write_archive(lines(spark, ("1", "good day #a"), ("2", "bad day #a")), inc.archive, 0)
    assert run(inc, asked) == [0]
    W.write_archive(lines(spark, ("3", "a table #a"), ("1", "good day #a")), inc.archive, 1)
    W.write_archive(lines(spark, ("4", "great #a")), inc.archive, 2)
    assert run(inc, asked) == [1, 2] and run(inc, asked) == []
    assert asked == [{"0"}, {"1", "2"}]
    got = {r["_id"]: r["sentiment"] for r in inc.read().collect()}
    assert got == {"1": "positive", "2": "negative", "3": "neutral", "4": "positive"} and inc.read().count() == 4
    inc.compact()
    assert {r["_id"]: r["sentiment"] for r in inc.read().collect()} == got
    assert manifest.read(spark, inc.path)[1]["batches"] == [[0, 2]]


def test_a_crash_before_the_commit_loses_nothing(spark, monkeypatch):
    root = scratch_path(spark, "increments")
    inc = INC.SentimentIncrements(spark, f"{root}/archive", f"{root}/sentiment")
    W.write_archive(lines(spark, ("1", "good day #a")), inc.archive, 0)
    run(inc)
    W.write_archive(lines(spark, ("2", "bad day #a")), inc.archive, 1)
    with monkeypatch.context() as m:
        m.setattr(INC.manifest, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            run(inc)
    assert [r["_id"] for r in inc.read().collect()] == ["1"]  # written, but not committed
    W.write_archive(lines(spark, ("3", "great day #a")), inc.archive, 2)
    assert run(inc) == [1, 2]
    assert sorted(r["_id"] for r in inc.read().collect()) == ["1", "2", "3"]


def test_ranges():
    assert INC.ranges([3, 1, 2, 7, 7]) == [[1, 3], [7, 7]] and INC.ranges([]) == []
    assert INC._joined([[0, 3], [6, 6]], [[4, 5], [9, 9]]) == [[0, 6], [9, 9]]


def test_batch_job_by_increments_equals_the_full_one(spark):
    views = scratch_path(spark, "views")
    for batch, posts in enumerate(([("1", "good day #a"), ("2", "bad #a")], [("3", "good bad day #a"), ("1", "good day #a")])):
        W.write_archive(lines(spark, *posts), f"{views}/archive", batch)
        assert jobs.batch_increment(spark, views, default_lexicon(), all_english=True) == [batch]
    full = sorted(map(tuple, jobs.batch(spark, views, default_lexicon(), all_english=True).collect()))
    assert sorted(map(tuple, jobs.sentiment(spark, views).collect())) == full and len(full) == 3
