from pyspark.sql import functions as F

from tagpulse.operators import language as L
from tagpulse.plans.catalog import _archive_posts
from tagpulse.sources.tables import read_table


def test_trigrams(spark):
    df = spark.createDataFrame([("Ab, ÇA!",), ("",), ("123",), (None,)], "t string")
    got = [r[0] for r in df.select(L.trigrams("t")).collect()]
    assert got[0] == [" ab", "ab ", " ça", "ça "]
    assert got[1] == [] and got[2] == []


def test_held_out_accuracy(spark, sf_small):
    """Trained on four fifths of the documents by a hash of their id, tested on the rest."""
    documents = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0
    train, test = documents.where(~held_out), documents.where(held_out)
    detected = L.detect(test.select(F.col("doc_id").alias("id"), "text"), L.train_profiles(train), L.training_vocabulary(train))
    row = test.select(F.col("doc_id").alias("id"), F.col("lang").alias("truth")).join(detected, "id", "left").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("lang") == F.col("truth")).cast("int")).alias("hit")).first()
    print(f"held-out language accuracy: {row['hit']} of {row['n']}")
    assert row["n"] > 150 and row["hit"] / row["n"] > 0.95


def test_vocabulary_does_not_change_the_result(spark, sf_small):
    documents = read_table(spark, sf_small, "documents").select("text", "lang")
    posts = _archive_posts(spark, sf_small).select("id", "text")
    profiles = L.train_profiles(documents)
    full = sorted(map(tuple, L.detect(posts, profiles, L.training_vocabulary(documents)).collect()))
    # a vocabulary that misses most words forces the trigram fallback
    fallback = sorted(map(tuple, L.detect(posts, profiles, L.training_vocabulary(documents.limit(3))).collect()))
    assert full == fallback and full


def test_posts_are_scanned_once(spark, sf_small, tmp_path):
    documents = read_table(spark, sf_small, "documents").select("text", "lang")
    path = str(tmp_path / "only_posts")
    _archive_posts(spark, sf_small).select("id", "text").write.parquet(path)
    detected = L.detect(spark.read.parquet(path), L.train_profiles(documents), L.training_vocabulary(documents))
    plan = detected._jdf.queryExecution().executedPlan().toString()
    assert plan.count("struct<id:string,text:string>") == 1


def test_any_number_of_languages_and_none(spark):
    rows = [(f"word{chr(97 + i // 26)}{chr(97 + i % 26)} tail", f"l{i:04d}") for i in range(120)]
    labelled = spark.createDataFrame(rows, "text string, lang string")
    posts = spark.createDataFrame([("1", "wordaa"), ("2", "wordcz"), ("3", "zzz")], "id string, text string")
    got = dict(map(tuple, L.detect(posts, L.train_profiles(labelled), L.training_vocabulary(labelled)).collect()))
    assert got == {"1": "l0000", "2": "l0077"}
    none = labelled.limit(0)
    assert L.detect(posts, L.train_profiles(none), L.training_vocabulary(none)).count() == 0
