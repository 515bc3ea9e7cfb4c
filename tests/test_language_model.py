"""The stored language model: the answers of ``detect`` in the row, versions, and English posts of a stream."""

import pytest
from pyspark.sql import functions as F

from tagpulse import jobs
from tagpulse.functions.lexicon import default_lexicon
from tagpulse.operators import language as L
from tagpulse.operators import language_model as LM
from tagpulse.operators.speed import to_records
from tagpulse.plans.catalog import _archive_posts
from tagpulse.session import scratch_path
from tagpulse.sinks import manifest
from tagpulse.sources.tables import read_table
from tagpulse.streaming.speed_layer import run_speed_layer, start_speed_layer

LABELLED = [("the cat and the dog", "en"), ("the house on the hill", "en"), ("der hund und die katze", "de"), ("das haus am berg", "de"),
            ("no label", None), (None, "en"), ("", "de")]


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.createDataFrame(LABELLED, "text string, lang string")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_equals_detect_in_the_row_and_joined(spark, sf_small, monkeypatch):
    documents = read_table(spark, sf_small, "documents").select("text", "lang")
    posts = _archive_posts(spark, sf_small).select("id", "text")
    expected = _rows(L.detect(posts, L.train_profiles(documents), L.training_vocabulary(documents)))
    english = sorted(i for i, lang in expected if lang == "en")
    path = scratch_path(spark, "test-model")
    LM.save(spark, path, documents)
    model = LM.load(spark, path)
    assert model.narrow and _rows(model.detect(posts)) == expected
    assert sorted(r["id"] for r in model.english(posts).collect()) == english
    # Too large to be folded into the plan: joined by trigram.
    monkeypatch.setattr(LM, "INLINE_COUNTS", 0)
    assert not model.narrow and _rows(model.detect(posts)) == expected
    assert sorted(r["id"] for r in model.english(posts).collect()) == english
    with pytest.raises(ValueError):
        model.language("text")


def test_frequent_words_steer_effort_only(spark, labelled, monkeypatch):
    texts = spark.createDataFrame([(str(i), t) for i, t in enumerate(
        ["the dog", "der hund", "Hund, Katze!", "catalogue of houses", "häuser", "12 34", "", None, "q", "the " * 5000 + "und"])], "id string, text string")
    answers = []
    for most in (200_000, 4, 0):
        monkeypatch.setattr(LM, "FREQUENT_COUNTS", most)
        path = scratch_path(spark, "test-words")
        LM.save(spark, path, labelled)
        model = LM.load(spark, path)
        assert model.n_words <= most // 2
        answers.append(_rows(model.detect(texts)))
    expected = _rows(L.detect(texts, L.train_profiles(labelled), L.training_vocabulary(labelled)))
    assert answers == [expected] * 3 and {"5", "6", "7"}.isdisjoint(i for i, _ in expected)


def test_no_exchange_and_one_evaluation(spark, labelled, tmp_path):
    path = scratch_path(spark, "test-plan")
    LM.save(spark, path, labelled)
    spark.createDataFrame([("1", "the dog")], "id string, text string").write.parquet(str(tmp_path / "posts"))
    english = LM.load(spark, path).english(spark.read.parquet(str(tmp_path / "posts")))
    plan = english._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("aggregate(") >= 1
    assert [r["id"] for r in english.collect()] == ["1"]


def test_texts_are_added_up_outside_of_lambdas(spark, labelled):
    path = scratch_path(spark, "test-sent")
    LM.save(spark, path, labelled)
    model = LM.load(spark, path)
    texts = ["the dog", "der hund", "Hund, Katze!", "12 34", "", None, "h\u00e4user", "\U0001d49c\U0001d4b7 katze", "the " * 3000 + "und", "catalogue"]
    posts = spark.createDataFrame([(i, t, str(i)) for i, t in enumerate(texts)], "n int, text string, id string").repartition(3)
    for found in (model.english(posts), model.detect(posts)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "from_json" not in plan and "transform(" not in plan
    # The same answers as the column's, columns and their order as they came.
    of_column = posts.select("id", model.language("text").alias("lang")).where("lang is not null")
    assert _rows(model.detect(posts)) == _rows(of_column) and 0 < of_column.count() < len(texts)
    assert model.english(posts).schema == posts.schema
    assert _rows(model.english(posts)) == _rows(posts.where(model.language("text") == "en"))
    # Sent once for a loaded model, however many micro-batches ask it.
    sent = model._constants["sent"]
    assert model.english(posts).count() == 3 and model._constants["sent"] is sent


def test_versions(spark, labelled):
    path = scratch_path(spark, "test-versions")
    with pytest.raises(FileNotFoundError):
        LM.load(spark, path)
    assert LM.save(spark, path, labelled.where("lang = 'en'")) == 0
    first = LM.load(spark, path)
    assert LM.save(spark, path, labelled) == 1
    assert [lang for lang, _ in first.languages] == ["en"] and [lang for lang, _ in LM.load(spark, path).languages] == ["de", "en"]
    # The version before stays for running readers; older ones go.
    texts = spark.createDataFrame([("1", "katze")], "id string, text string")
    assert _rows(LM.load(spark, path, 0).detect(texts)) == []
    LM.save(spark, path, labelled)
    assert manifest.versions(spark, path) == [1, 2]


def test_model_without_languages(spark, labelled):
    path = scratch_path(spark, "test-none")
    LM.save(spark, path, labelled.limit(0))
    model = LM.load(spark, path)
    texts = spark.createDataFrame([("1", "katze")], "id string, text string")
    assert model.detect(texts).count() == 0 and model.english(texts).count() == 0


def test_english_of_a_stream_and_jobs(spark, labelled):
    root = scratch_path(spark, "test-stream-english")
    rows = [("1", "the dog #a", "t"), ("2", "der hund #a", "t"), ("3", "the cat", "t"), ("4", "the house #b", "t")]
    posts = spark.createDataFrame(rows, "id string, text string, created string")
    assert jobs.learn(spark, labelled, f"{root}/model") == 0
    run = run_speed_layer(spark, to_records(posts), f"{root}/run", files_per_trigger=1, model=LM.load(spark, f"{root}/model"))
    assert sorted(r["id"] for r in run.english().collect()) == ["1", "4"]
    jobs.speed(spark, f"{root}/run/records", f"{root}/views", once=True, model=f"{root}/model")
    view = jobs.batch(spark, f"{root}/views", default_lexicon(), model=f"{root}/model")
    assert sorted(r["_id"] for r in view.collect()) == ["1", "4"]
    assert jobs.batch_increment(spark, f"{root}/views", default_lexicon(), model=f"{root}/model")
    assert sorted(r["_id"] for r in jobs.sentiment(spark, f"{root}/views").collect()) == ["1", "4"]
    with pytest.raises(ValueError):
        jobs.batch(spark, f"{root}/views", default_lexicon(), labelled, model=f"{root}/model")
    with pytest.raises(ValueError):
        start_speed_layer(posts, "s", "a", "c", model=LM.load(spark, f"{root}/model"))
