"""Batch layer: English selection, cleaning, stop words, polarity scores, labels.

The whole chain is one narrow projection per row (no shuffle) except the
de-duplication of replayed posts.  That runs last, on the smallest rows
(English only, cleaned and stop-word-free text, one label), with map-side
partial aggregation, so a post replayed many times collapses before the
exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.functions import text as T
from tagpulse.functions.lexicon import NEGATIVE, POSITIVE, STOP, Lexicon, LexiconTable, word_bits
from tagpulse.session import more_tasks, split_repeated, stored

# --- fixed values -------------------------------------------------------------
ENGLISH = "en"
POSITIVE_LABEL, NEGATIVE_LABEL, NEUTRAL_LABEL = "positive", "negative", "neutral"
# ------------------------------------------------------------------------------


def dedupe_posts(posts: DataFrame) -> DataFrame:
    """D2 on raw posts: one row per ``id`` (the smallest text when copies
    disagree).  The batch layer uses ``dedupe_view`` instead, on smaller rows."""
    return posts.groupBy("id").agg(F.min("text").alias("text"))


def dedupe_view(view: DataFrame) -> DataFrame:
    """One sentiment row per ``_id`` (the smallest ``(text, sentiment)``).

    Copies of a post have the same text and hence the same label, so this is
    the same as de-duplicating the raw posts first, with less data shuffled.

    The ids are counted first, without their texts: only rows of an id that comes
    again are moved and grouped, others pass where they are, however many ids come again.
    """
    once, again = split_repeated(view.select("_id", "text", "sentiment"), "_id")
    first = again.groupBy("_id").agg(F.min(F.struct("text", "sentiment")).alias("r"))
    return once.unionByName(first.select("_id", "r.text", "r.sentiment"))


def english_by_column(posts: DataFrame, lang_col: str = "lang") -> DataFrame:
    """F4 (a): keep posts whose language column says English."""
    return posts.where(F.col(lang_col) == ENGLISH)


def clean(posts: DataFrame) -> DataFrame:
    """P6 + P7 + F3 + F5: ``id, text`` with the cleaned, non-empty text.

    F5 is tested on the raw text (``has_letter``), which is equivalent and
    keeps every filter of the chain ahead of the regex work.
    """
    return (posts.where(F.col("text").isNotNull() & T.has_letter("text"))
            .select("id", T.clean_text("text").alias("text")))


def strip_stop_words(cleaned: DataFrame, lexicon: Lexicon | LexiconTable) -> DataFrame:
    """P8 + F6: remove interior stop words.

    F6 (not blank afterwards) needs no filter: P8 never removes the first
    token, and ``clean`` only passes non-empty texts.
    """
    if isinstance(lexicon, LexiconTable):
        return strip_stop_words_by_join(cleaned, lexicon.frame)
    return cleaned.select("id", T.remove_stop_words("text", lexicon.words(STOP)).alias("text"))


def keyed(posts: DataFrame) -> DataFrame:
    """Adds ``key``, a 128-bit hash of the text: with ``id`` it stands for ``(id, text)``
    in joins, so that texts themselves are neither shuffled twice nor sorted."""
    return posts.withColumn("key", F.md5("text"))


def _matches(posts: DataFrame, words: DataFrame) -> DataFrame:
    """``id, key, word, n`` + the columns of ``words``: the tokens of each distinct post that are
    words of a lexicon, counted before they are joined.  No text is carried along.

    A bit set of the lexicon is asked in the row, before tokens are exploded: what is counted and joined are the hits
    and a few others, whichever join Spark takes."""
    bits = word_bits(words)
    tokens = posts.select("id", "key", F.explode(F.filter(T.tokens("text"), bits.may_hold)).alias("word"))
    return tokens.groupBy("id", "key", "word").agg(F.count(F.lit(1)).alias("n")).join(words, "word")


def strip_stop_words_by_join(cleaned: DataFrame, lexicon_df: DataFrame) -> DataFrame:
    """P8 with a stop list of any size: each post gets the stop words it holds.

    The first and the last token stay, and every other that is no stop word;
    neighbours keep the white space between them, others get one space.
    """
    stop = lexicon_df.where(F.col("category") == STOP).select("word").distinct()
    posts = stored(keyed(cleaned), "cleaned")
    found = _matches(posts, stop).groupBy("id", "key").agg(F.collect_set("word").alias("found"))
    rows = posts.join(found, ["id", "key"], "left").select(
        "id", T.tokens("text").alias("parts"), F.regexp_extract_all("text", F.lit(r"(\s+)"), 1).alias("gaps"),
        F.coalesce("found", F.array().cast("array<string>")).alias("found"))
    tokens = F.arrays_zip(F.col("parts").alias("word"), F.concat(F.array(F.lit("")), "gaps").alias("gap"))
    numbered = F.transform(tokens, lambda t, i: F.struct(t["word"].alias("word"), t["gap"].alias("gap"), i.alias("i")))
    kept = F.filter(numbered, lambda t: (t["i"] == 0) | (t["i"] == F.size("parts") - 1) | ~F.array_contains("found", t["word"]))
    rows = rows.withColumn("kept", kept)
    spaced = F.transform("kept", lambda t, k: F.concat(
        F.when(k == 0, F.lit("")).when(F.get(F.col("kept"), k - 1)["i"] == t["i"] - 1, t["gap"]).otherwise(F.lit(" ")), t["word"]))
    return rows.select("id", F.array_join(spaced, "").alias("text"))


def tokenized(stemmed: DataFrame) -> DataFrame:
    """P9 + A3: ``id, text, n_tokens, tokens_text`` (tokens joined by one space)."""
    toks = T.tokens("text")
    return stemmed.select("id", "text", F.size(toks).alias("n_tokens"),
                          F.array_join(toks, " ").alias("tokens_text"))


def _ratio(hits: str, total: str):
    # float(hits) / float(total) as in the original; double division rounded
    # once to float gives the same value as a float division.
    return (F.col(hits).cast("double") / F.col(total)).cast("float")


def score(stemmed: DataFrame, lexicon: Lexicon | LexiconTable) -> DataFrame:
    """P10 + P11 + A1 + A2 in one projection (the original joins two passes).

    Output ``id, text, n_tokens, pos_hits, neg_hits, pos_score, neg_score``.
    """
    if isinstance(lexicon, LexiconTable):
        return score_with_lexicon_frame(stemmed, lexicon.frame)
    toks = T.tokens("text")
    counted = stemmed.select(
        "id", "text",
        F.size(toks).alias("n_tokens"),
        T.count_members(toks, lexicon.words(POSITIVE)).alias("pos_hits"),
        T.count_members(toks, lexicon.words(NEGATIVE)).alias("neg_hits"),
    )
    return counted.withColumn("pos_score", _ratio("pos_hits", "n_tokens")) \
                  .withColumn("neg_score", _ratio("neg_hits", "n_tokens"))


def score_with_lexicon_frame(stemmed: DataFrame, lexicon_df: DataFrame) -> DataFrame:
    """P10/P11 for lexicons too large to inline: tokens joined to the lexicon.

    The distinct posts' tokens are counted per ``(id, text hash, word)`` and
    joined on ``word`` (Spark broadcasts the lexicon when its size is under the
    broadcast threshold and otherwise shuffles; AQE splits a hot word).  Totals
    come from the projection, and every input row (copies included) gets its
    counts through a left join, so posts without a hit keep zero counts.
    """
    # Three passes read the rows: they are made once and stored.
    words = lexicon_df.where(F.col("category").isin(POSITIVE, NEGATIVE)) \
        .groupBy("word").agg(F.max((F.col("category") == POSITIVE).cast("int")).alias("is_pos"),
                             F.max((F.col("category") == NEGATIVE).cast("int")).alias("is_neg"))
    rows = stored(keyed(stemmed), "scored")
    # Tokens of a copied post are counted once for each copy; the copies divide them out.
    copies = rows.groupBy("id", "key").agg(F.count(F.lit(1)).alias("copies"))
    hits = _matches(rows, words).groupBy("id", "key").agg(
        F.sum(F.col("n") * F.col("is_pos")).alias("pos"), F.sum(F.col("n") * F.col("is_neg")).alias("neg"))
    hits = hits.join(copies, ["id", "key"])
    counted = rows.join(hits, ["id", "key"], "left").select(
        "id", "text", F.size(T.tokens("text")).alias("n_tokens"),
        F.coalesce((F.col("pos") / F.col("copies")).cast("int"), F.lit(0)).alias("pos_hits"),
        F.coalesce((F.col("neg") / F.col("copies")).cast("int"), F.lit(0)).alias("neg_hits"),
    )
    return counted.withColumn("pos_score", _ratio("pos_hits", "n_tokens")) \
                  .withColumn("neg_score", _ratio("neg_hits", "n_tokens"))


def score_by_join(stemmed: DataFrame, lexicon: Lexicon) -> DataFrame:
    """J1 as written in the original: a positive pass and a negative pass
    joined on ``(id, text)``, here by ``id`` and the text's hash, with the text
    on one side only.  For distinct keys the join is 1:1 and the result equals
    ``score`` (k copies of a key give k^2 rows, as in the original); kept to
    show that equality.

    A text is cut into tokens once, when the rows are stored; both passes read
    their counts, and the negative one reads no text."""
    rows = T.made_once(keyed(stemmed), "tokens", T.tokens("text")).select("id", "key", "text", F.size("tokens").alias("n_tokens"), "tokens")
    both = T.matchable_words({*lexicon.words(POSITIVE), *lexicon.words(NEGATIVE)})
    if len(both) > T.FEW_WORDS:
        rows = T.made_once(rows, "tokens", F.filter("tokens", lambda w: w.isin(both)))
    counted = rows.select("id", "key", "text", "n_tokens",
                          T.count_made_members("tokens", lexicon.words(POSITIVE)).alias("pos_hits"),
                          T.count_made_members("tokens", lexicon.words(NEGATIVE)).alias("neg_hits"))
    with more_tasks(stemmed.sparkSession):
        scored = stored(counted, "scored")
    pos = scored.select("id", "key", "text", "n_tokens", "pos_hits")
    neg = scored.select("id", "key", "neg_hits")
    joined = pos.join(neg, ["id", "key"], "inner").drop("key")
    return joined.withColumn("pos_score", _ratio("pos_hits", "n_tokens")) \
                 .withColumn("neg_score", _ratio("neg_hits", "n_tokens"))


def sentiment_of(pos_score, neg_score):
    """Pos > neg -> positive; pos < neg -> negative; else neutral."""
    return (F.when(pos_score > neg_score, F.lit(POSITIVE_LABEL))
            .when(pos_score < neg_score, F.lit(NEGATIVE_LABEL))
            .otherwise(F.lit(NEUTRAL_LABEL)))


def label(scored: DataFrame) -> DataFrame:
    """P12 + P13: ``_id, text, sentiment``.

    Both scores share the denominator, so comparing the scores is comparing
    the hit counts.
    """
    sentiment = sentiment_of(F.col("pos_score"), F.col("neg_score"))
    return scored.select(F.col("id").alias("_id"), "text", sentiment.alias("sentiment"))


def scored_tweets(scored: DataFrame) -> DataFrame:
    """The declared ``ScoredTweet`` shape: ``id, text, pos_score, neg_score, type``."""
    return scored.select("id", "text", "pos_score", "neg_score",
                         sentiment_of(F.col("pos_score"), F.col("neg_score")).alias("type"))


def stemmed_english(posts: DataFrame, lexicon: Lexicon | LexiconTable, english: DataFrame | None = None) -> DataFrame:
    """Archive posts -> English posts -> cleaned -> stop words out (narrow).

    ``english`` optionally supplies the English ids (from language detection)
    instead of a ``lang`` column.
    """
    if english is None:
        selected = english_by_column(posts)
    else:
        selected = posts.join(english, "id", "left_semi")
    return strip_stop_words(clean(selected.select("id", "text")), lexicon)


def sentiment_view(posts: DataFrame, lexicon: Lexicon | LexiconTable, english: DataFrame | None = None) -> DataFrame:
    """The whole batch layer: ``_id, text, sentiment``, one row per ``_id``."""
    return dedupe_view(label(score(stemmed_english(posts, lexicon, english), lexicon)))


def with_labels(posts: DataFrame, lexicon: Lexicon, lang_col: str = "lang") -> DataFrame:
    """The posts' columns without the text, with ``sentiment``: the label of ``label_rows``, null for a post that has none.

    The summary and the labels are then columns of the same rows, so the posts are made and read once for both.  No text without its
    stop words is needed for that: stop words go from among the tokens of the cleaned text, all but a first and a last one."""
    others = [c for c in posts.columns if c != "text"]
    text = F.when((F.col(lang_col) == ENGLISH) & T.has_letter("text"), T.clean_text("text"))
    tokens = T.made_once(posts.select(*others, text.alias("tokens")), "tokens", T.tokens("tokens"))
    stop = T.matchable_words(lexicon.words(STOP))
    counted = tokens.select(
        *others, F.col("tokens").isNotNull().alias("labelled"), (F.size("tokens") - T.count_inside("tokens", stop)).alias("n_tokens"),
        T.count_left("tokens", lexicon.words(POSITIVE), stop).alias("pos_hits"), T.count_left("tokens", lexicon.words(NEGATIVE), stop).alias("neg_hits"))
    sentiment = F.when(F.col("labelled"), sentiment_of(_ratio("pos_hits", "n_tokens"), _ratio("neg_hits", "n_tokens")))
    return counted.select(*others, sentiment.alias("sentiment"))


def label_rows(posts: DataFrame, lexicon: Lexicon | LexiconTable, english: DataFrame | None = None) -> DataFrame:
    """``_id, sentiment`` of every English post, one row per copy: what the serving
    layer reads of the view, so no text is shuffled for it."""
    return label(score(stemmed_english(posts, lexicon, english), lexicon)).select("_id", "sentiment")
