import random

from tagpulse.functions.lexicon import Lexicon, LexiconTable, default_lexicon, lexicon_frame, load_lexicon
from tagpulse.operators import sentiment as S
from tagpulse.operators.speed import parse_records, rejected_records, texts
from tests.models import stop_words_rule

LEX = Lexicon(stop=("the", "is", "like", "a"), positive=frozenset({"good", "like", "great"}),
              negative=frozenset({"bad", "trash"}))


def _posts(spark, rows):
    return spark.createDataFrame(rows, "id string, lang string, text string")


def test_labels(spark):
    rows = [("1", "en", "The movie is good, GREAT!"), ("2", "en", "bad bad good"),
            ("3", "en", "like the rest"), ("4", "fr", "good good"), ("5", "en", "42 !!"),
            ("6", "en", "a like a")]
    got = {r["_id"]: (r["text"], r["sentiment"]) for r in S.sentiment_view(_posts(spark, rows), LEX).collect()}
    assert got["1"] == ("the movie good great", "positive")
    assert got["2"] == ("bad bad good", "negative")
    assert got["3"] == ("like rest", "positive")  # edge word kept and counted
    assert "4" not in got and "5" not in got       # not English / empty after cleaning
    assert got["6"] == ("a a", "neutral")


def test_duplicates_give_one_row(spark):
    rows = [("1", "en", "good day"), ("1", "en", "good day"), ("2", "en", "bad day")]
    assert S.sentiment_view(_posts(spark, rows), LEX).count() == 2


def test_score_paths_agree(spark):
    rows = [(str(i), "en", t) for i, t in enumerate(
        ["good bad the good", "trash", "great like the like", "nothing here", "good"])]
    stemmed = S.stemmed_english(_posts(spark, rows), LEX)
    cols = ["id", "text", "n_tokens", "pos_hits", "neg_hits", "pos_score", "neg_score"]
    a = sorted(map(tuple, S.score(stemmed, LEX).select(cols).collect()))
    b = sorted(map(tuple, S.score_by_join(stemmed, LEX).select(cols).collect()))
    c = sorted(map(tuple, S.score_with_lexicon_frame(stemmed, LEX.to_frame(spark)).select(cols).collect()))
    assert a == b == c


def test_lexicon_files(spark, tmp_path):
    for name, words in (("s", ["the", "co.", "the"]), ("p", ["good", "well-done"]), ("n", ["bad"])):
        (tmp_path / f"{name}.txt").write_text("\n".join(words) + "\n")
    paths = [str(tmp_path / f"{n}.txt") for n in ("s", "p", "n")]
    frame = lexicon_frame(spark, *paths)
    assert frame.count() == 5
    lex = load_lexicon(spark, *paths)
    assert set(lex.stop) == {"the", "co."} and lex.positive == {"good", "well-done"}


def test_default_lexicon_is_small_and_ours():
    lex = default_lexicon()
    assert "like" in lex.stop and "like" in lex.positive
    assert lex.negative == {"bad", "trash", "stupid"}


def test_bad_json_dropped(spark):
    lines = spark.createDataFrame([('{"id": 5, "text": "hi #a", "created": "x"}',), ("not json",),
                                   ('{"id": 6, "created": "x"}',), ('{"text": "no id", "created": "x"}',),
                                   ('{"id": 7, "text": "cut',), (None,)], "value string")
    got = parse_records(lines).collect()
    assert [(r["id"], r["text"]) for r in got] == [("5", "hi #a")]
    assert [r["text"] for r in texts(lines).collect()] == ["hi #a"]
    assert rejected_records(lines).count() == 5


def test_lexicon_join_keeps_copies(spark):
    rows = [("1", "en", "good bad good"), ("1", "en", "good bad good"), ("2", "en", "trash")]
    stemmed = S.stemmed_english(_posts(spark, rows), LEX)
    cols = ["id", "text", "n_tokens", "pos_hits", "neg_hits", "pos_score", "neg_score"]
    a = sorted(map(tuple, S.score(stemmed, LEX).select(cols).collect()))
    b = sorted(map(tuple, S.score_with_lexicon_frame(stemmed, LEX.to_frame(spark)).select(cols).collect()))
    assert a == b and len(a) == 3


def test_lexicon_of_any_size_gives_the_same_view(spark, tmp_path):
    """The same lists, folded into the plan and joined as a table (the route beyond the inline size)."""
    rnd = random.Random(9)
    stop, pos, neg = ["the", "is", "of", "like", "then"], ["good", "like"], ["bad", "trash"]
    for name, words in (("s", stop), ("p", pos), ("n", neg)):
        (tmp_path / f"{name}.txt").write_text("\n".join(words) + "\n")
    paths = [str(tmp_path / f"{n}.txt") for n in "spn"]
    small, large = load_lexicon(spark, *paths), load_lexicon(spark, *paths, inline_words=2)
    assert isinstance(small, Lexicon) and isinstance(large, LexiconTable)
    vocabulary = [*stop, *pos, *neg, "cat", "them", "x"]
    rows = [(str(i), "en", "".join(rnd.choice(vocabulary) + rnd.choice([" ", "  ", "\t "]) for _ in range(rnd.randint(1, 30)))) for i in range(200)]
    rows += rows[:5] + [("one", "en", "the"), ("two", "en", "the of"), ("run", "en", "cat " + "the " * 3000 + "good")]
    posts = _posts(spark, rows)
    stemmed = [sorted(map(tuple, S.stemmed_english(posts, lex).collect())) for lex in (small, large)]
    assert stemmed[0] == stemmed[1]
    assert stemmed[0] == sorted((i, stop_words_rule(t.strip(), set(stop))) for i, _, t in rows)
    views = [sorted(map(tuple, S.sentiment_view(posts, lex).collect())) for lex in (small, large)]
    assert views[0] == views[1]
