"""ingest -> speed -> batch -> serve over files equals the direct DataFrame query; arguments; upkeep of the views."""

import io

import pytest
from pyspark.sql import functions as F

from tagpulse import jobs
from tagpulse.functions.lexicon import default_lexicon
from tagpulse.functions.text import has_hashtag
from tagpulse.operators import intervals as I
from tagpulse.operators import language as L
from tagpulse.operators import sentiment as S
from tagpulse.operators.speed import summarize
from tagpulse.session import scratch_path
from tagpulse.sinks import writers as W
from tagpulse.sources.posts import posts as derive_posts
from tagpulse.sources.posts import raw_posts
from tagpulse.sources.tables import read_table
from tagpulse.sources.views import read_sentiment_view, read_summary_view

COLS = ["hashtag", "start_ts", "end_ts", "seconds", "tweets"]


def test_lambda_end_to_end(spark, sf_small):
    root = scratch_path(spark, "test-jobs")
    raw_posts(spark, sf_small).select("id", "text", "created").write.json(f"{root}/posts")
    jobs.ingest(spark, f"{root}/posts", f"{root}/records")
    jobs.speed(spark, f"{root}/records", f"{root}/views", once=True)
    labelled = read_table(spark, sf_small, "documents").select("text", "lang")
    view = jobs.batch(spark, f"{root}/views", default_lexicon(), labelled)
    assert view.count() > 0

    # Direct chain: same detection, no files in between.
    posts = derive_posts(spark, sf_small)
    archive = posts.where(has_hashtag("text")).select("id", "text")
    english = L.english_ids(L.detect(archive, L.train_profiles(labelled), L.training_vocabulary(labelled)))
    direct_sentiment = S.sentiment_view(archive, default_lexicon(), english=english)
    direct = I.positive_intervals(summarize(posts), direct_sentiment).select(COLS)
    expected = sorted(map(tuple, direct.collect()))
    _, served = jobs.serve_frames(spark, f"{root}/views", None)
    assert sorted(map(tuple, served().select(COLS).collect())) == expected

    for _ in range(2):  # before and after compaction
        out = io.StringIO()
        served = jobs.serve(spark, f"{root}/views", "#click", out=out)
        assert "Hashtag:   #click" in out.getvalue()
        assert sorted(map(tuple, served.select(COLS).collect())) == [e for e in expected if e[0] == "#click"]
        out = io.StringIO()
        assert jobs.serve(spark, f"{root}/views", "#absent", out=out) is None
        assert out.getvalue().strip() == "There is no hashtag '#absent' in the database."
        assert jobs.compact(spark, f"{root}/views") == 0


def test_ingest_as_a_stream(spark, tmp_path):
    (tmp_path / "posts").mkdir()
    (tmp_path / "posts" / "a.json").write_text('{"id": 5, "text": "one:\\ntwo #a", "created": "Wed Jun 16 12:34:56 UTC 2021"}\n')
    jobs.ingest(spark, str(tmp_path / "posts"), str(tmp_path / "records"), stream=True, once=True).awaitTermination()
    (row,) = spark.read.parquet(str(tmp_path / "records")).collect()
    assert row["key"] == "5" and '"one two #a"' in row["value"] and "Wed Jun 16 123456 UTC 2021" in row["value"]


def test_one_tag_reaches_the_scan(spark):
    root = scratch_path(spark, "test-tag")
    rows = spark.createDataFrame([("1", "#a", "x"), ("2", "#b", "x")], "_id string, hashtag string, time string")
    W.write_batch_view(rows, root, 0)
    df = read_summary_view(spark, root, "#a")
    assert [r["_id"] for r in df.collect()] == ["1"]
    assert "EqualTo(hashtag,#a)" in df._jdf.queryExecution().executedPlan().toString()


def test_replay_after_compaction(spark):
    root = scratch_path(spark, "test-compact")
    make = lambda rows: spark.createDataFrame(rows, "_id string, hashtag string, time string")
    W.write_batch_view(make([("1", "#a", "Mon Jan 01 000001 UTC 2024"), ("2", "#b", "no time")]), root, 0)
    W.write_batch_view(make([("1", "#a", "Mon Jan 01 000001 UTC 2024"), ("3", "#a", "Tue Jan 02 000001 UTC 2024")]), root, 1)
    before = sorted(map(tuple, read_summary_view(spark, root).collect()))
    assert len(before) == 3
    assert W.compact_summary(spark, root) == 1 and W.batches(spark, root) == []
    assert sorted(map(tuple, read_summary_view(spark, root).collect())) == before
    W.write_batch_view(make([("1", "#a", "Mon Jan 01 000001 UTC 2024")]), root, 1)  # the batch runs again
    W.write_batch_view(make([("4", "#c", "x"), ("2", "#b", "no time")]), root, 2)
    after = sorted(map(tuple, read_summary_view(spark, root).collect()))
    assert after == sorted([*before, ("4", "#c", "x")])
    assert W.compact_summary(spark, root) == 2 and W.batches(spark, root) == []
    assert sorted(map(tuple, read_summary_view(spark, root).collect())) == after
    assert [r["_id"] for r in read_summary_view(spark, root, "#c").collect()] == ["4"]


def test_a_failed_write_leaves_the_old_view(spark):
    root = scratch_path(spark, "test-versions")
    make = lambda t: spark.createDataFrame([("1", t, "positive")], "_id string, text string, sentiment string")
    assert read_sentiment_view(spark, root).count() == 0
    assert W.write_view(make("old"), root) == 0
    reader = read_sentiment_view(spark, root)
    with pytest.raises(Exception):  # noqa: B017
        W.write_view(make("new").withColumn("text", F.raise_error(F.lit("lost"))), root)
    assert [r["text"] for r in read_sentiment_view(spark, root).collect()] == ["old"]
    W.write_view(make("new"), root)
    assert [r["text"] for r in read_sentiment_view(spark, root).collect()] == ["new"]
    assert [r["text"] for r in reader.collect()] == ["old"]  # a reader during the write


def test_batch_asks_which_posts_are_english(spark, tmp_path):
    with pytest.raises(ValueError):
        jobs.batch(spark, str(tmp_path), default_lexicon())
    with pytest.raises(ValueError):
        jobs.batch(spark, str(tmp_path), default_lexicon(), lang_column=True, all_english=True)


@pytest.mark.parametrize("argv", [
    ["batch", "--views", "v"], ["batch", "--views", "v", "--all-english"], ["batch", "--views", "v", "--packaged-lexicon"],
    ["batch", "--views", "v", "--all-english", "--lang-column", "--packaged-lexicon"], ["speed", "--views", "v"], ["tail"],
    ["tail", "--format", "kafka"], ["tail", "--records", "r", "--option", "novalue"], ["ingest", "--records", "r"],
    ["ingest", "--posts", "p", "--format", "kafka", "--option", "kafka.bootstrap.servers=h:1"]])
def test_incomplete_arguments_are_refused(argv):
    with pytest.raises(SystemExit):
        jobs.checked(jobs.parser().parse_args(argv)) if argv[0] != "batch" else jobs.parser().parse_args(argv)


def test_kafka_arguments_need_no_records():
    args = jobs.parser().parse_args(["speed", "--views", "v", "--format", "kafka", "--option", "kafka.bootstrap.servers=h:1", "--option", "subscribe=t=1"])
    assert jobs.checked(args) == {"kafka.bootstrap.servers": "h:1", "subscribe": "t=1"}


def test_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace as N

    from tagpulse.session import shared_dir
    conf = N(get=lambda key, default=None: default)
    session = N(conf=conf, sparkContext=N(getConf=lambda: conf, master="spark://h:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError):
        shared_dir(session)


def test_scratch_of_other_runs_stays(spark, tmp_path):
    from tagpulse.session import delete_path, run_dir, shared_dir
    assert run_dir(spark).startswith(f"{shared_dir(spark)}/tagpulse/") and run_dir(spark) == run_dir(spark)
    other = f"{shared_dir(spark)}/tagpulse/another-application/table"
    spark.range(3).write.mode("overwrite").parquet(other)
    mine = scratch_path(spark, "mine")
    assert mine.startswith(run_dir(spark) + "/") and not other.startswith(run_dir(spark))
    delete_path(spark, other)
