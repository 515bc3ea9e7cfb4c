import random

import pytest
from pyspark.sql import functions as F

from tagpulse.functions import text as T
from tests.models import stop_words_rule

# Literal rows: text -> first hashtag ("" = none).
HASHTAG_ROWS = [
    ("go #One and #Two", "#One"),
    ("#first only", ""),
    ("x (#y) #z!", "#z"),
    ("line1\nb #t", ""),
    ("end #w\n", ""),
    ("a\n\nb #q", ""),
    ("x#y z", ""),
    ("a #é", ""),
    ("caf #Año", "#A"),
    ("x\n#v", "#v"),
    ("\n#u", "#u"),
]


def test_hashtag_literal_rows(spark):
    df = spark.createDataFrame(HASHTAG_ROWS, "text string, expected string")
    got = df.select("expected", T.extract_hashtag("text").alias("tag"),
                    T.has_hashtag("text").alias("match")).collect()
    for row in got:
        assert row["tag"] == row["expected"]
        assert row["match"] == (row["expected"] != "")


def test_normalize(spark):
    df = spark.createDataFrame([("a:b\nc", "Wed Jun 16 12:34:56 CEST 2021")], "t string, c string")
    row = df.select(T.normalize_text("t").alias("t"), T.normalize_text("c").alias("c")).first()
    assert row["t"] == "ab c"
    assert row["c"] == "Wed Jun 16 123456 CEST 2021"


def test_clean(spark):
    df = spark.createDataFrame([(" \tHello, World! 42 \n",), ("123",), ("Çà va",)], "t string")
    got = [r[0] for r in df.select(T.clean_text("t")).collect()]
    assert got == ["hello world", "", "va"]


def test_stop_words_literal(spark):
    df = spark.createDataFrame([("the cat  is the  of dog a",)], "t string")
    got = df.select(T.remove_stop_words("t", {"the", "is", "of", "a"})).first()[0]
    assert got == "the cat dog a"


def test_stop_words_edges_and_overlap_with_positive(spark):
    df = spark.createDataFrame([("like it",), ("i like it like",)], "t string")
    got = [r[0] for r in df.select(T.remove_stop_words("t", {"like", "it"})).collect()]
    assert got == ["like it", "i like"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_stop_words_one_pass_equals_rule(spark, seed):
    rnd = random.Random(seed)
    vocab = ["a", "an", "the", "is", "of", "cat", "dog", "there", "then", "them", "x"]
    stop = {"a", "an", "the", "is", "of", "there"}
    seps = [" ", "  ", "\t", " \n "]
    texts = []
    for _ in range(400):
        n = rnd.randint(1, 12)
        words = [rnd.choice(vocab) for _ in range(n)]
        texts.append("".join(w + rnd.choice(seps) for w in words[:-1]) + words[-1])
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.remove_stop_words("t", stop)).collect()]
    assert got == [stop_words_rule(t, stop) for t in texts]


def test_tokens_and_members(spark):
    df = spark.createDataFrame([("good  bad good like",)], "t string")
    toks = T.tokens("t")
    row = df.select(F.size(toks).alias("n"), T.count_members(toks, {"good", "like", "no-one"}).alias("p")).first()
    assert (row["n"], row["p"]) == (4, 3)


def test_stop_pattern_skips_unmatchable_entries():
    assert T.matchable_words(["co.", "no-one", "Up", "the", ""]) == ["the"]
    assert T.stop_word_pattern([]) is None


def test_fast_non_letter_class_equals_original(spark):
    rnd = random.Random(11)
    alphabet = "aZmQ \t\n\x0b\f\r  é߀1_#:.-ÀÿΩж字\U0001F600"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(F.regexp_replace("t", T.NON_LETTER_PATTERN, "").alias("a"),
                    F.regexp_replace("t", T.NON_LETTER_PATTERN_JAVA, "").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got)


@pytest.mark.parametrize("seed", [21, 22])
def test_has_letter_equals_nonempty_clean_and_f6_is_implied(spark, seed):
    rnd = random.Random(seed)
    alphabet = "ab Z \t\n.,1é#-_"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    cleaned = T.clean_text("t")
    stop = T.remove_stop_words(cleaned, {"a", "b", "z"})
    rows = df.select(T.has_letter("t").alias("h"), (F.length(cleaned) > 0).alias("c"),
                     T.not_blank(stop).alias("nb")).collect()
    for r in rows:
        assert r["h"] == r["c"]
        if r["c"]:
            assert r["nb"]


def test_a_run_of_stop_words_may_have_any_length(spark, tmp_path):
    """20,000 consecutive stop words, read from a file."""
    stop = {"the", "then", "there", "of", "a", "an"}
    rnd = random.Random(5)
    texts = ["cat " + "the " * 20_000 + "dog", " ".join(["cat", *[rnd.choice(sorted(stop)) for _ in range(20_000)], "them"])]
    (tmp_path / "posts.txt").write_text("\n".join(texts) + "\n")
    got = [r[0] for r in spark.read.text(str(tmp_path / "posts.txt")).select(T.remove_stop_words("value", stop)).collect()]
    assert sorted(got) == ["cat dog", "cat them"]


def test_prefix_tree_matches_exactly_its_words():
    import re
    words = ["a", "an", "and", "andes", "the", "them", "then", "to", "x"]
    tree = re.compile(T.prefix_tree(words))
    for w in [*words, "", "t", "th", "ande", "thenx", "xa", "aa"]:
        assert bool(tree.fullmatch(w)) == (w in words), w


def test_a_stop_word_may_have_any_length(spark):
    long = "ab" * 5000
    tree = T.prefix_tree([long, long + "c", "ab"])
    import re
    assert re.fullmatch(tree, long + "c") and re.fullmatch(tree, "ab") and not re.fullmatch(tree, long + "d")
    df = spark.createDataFrame([(f"x {'ab' * 750} y",)], "t string")
    assert df.select(T.remove_stop_words("t", ["ab" * 750])).first()[0] == "x y"
