"""Language identification as a Spark job (F4 (b), L1).

The original asks a per-row third-party identifier whether a post is English.
Here it is relational work:

* **train**: every labelled document is cut into letter trigrams (each word
  padded with one space on both sides); ``(lang, gram) -> n`` counts form the
  profile of a language, and ``norm2 = sum(n^2)`` its squared length.
* **score**: ``dot(post, lang) = sum over the post's trigram occurrences of
  n``, and the cosine ranking is ``dot / sqrt(norm2)`` (the post's own length
  is the same for every language).  The best language wins; ties go to the
  larger code.  Trigrams never cross a word, so the sum is taken word by word.
  Profiles of up to ``INLINE_COUNTS`` counts are sent to the tasks, which add
  up each post where it lies (``with_dots``): what is shuffled is a post's id and
  its sums.  Larger profiles stay tables, and the words of the posts are joined to
  a per-word table built from the training words; other words are cut into
  trigrams on the spot.

All counts are integers, so ``dot / sqrt(norm2)`` is one correctly rounded
division of correctly rounded values: the ranking does not depend on the
order in which Spark adds partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tagpulse.session import ship_package, stored

# --- fixed values of the trigram definition (shared with the SQL twin) ---------
NON_LETTER_RUN = r"[^\p{L}]+"
GRAM = 3
# Overlapping windows of three characters whose middle one is not a space.
TRIGRAM_WINDOW = r"(?=(.[^ ].))"
# Counts (trigrams times languages) of the largest profiles that are sent to the tasks, about 10 MB.
INLINE_COUNTS = 1_000_000
# Distinct words whose sums a task keeps between batches.
KEPT_WORDS = 200_000
# --------------------------------------------------------------------------------


def trigrams(text: Column | str) -> Column:
    """Array of the letter trigrams of a text (words padded with spaces).

    The text becomes `` w1 w2 ... `` (lower-case letters, single spaces); every
    3-character window whose middle character is not a space is a padded
    per-word trigram.  A zero-width lookahead yields all overlapping windows
    in one linear regex pass.
    """
    c = F.col(text) if isinstance(text, str) else text
    words = F.trim(F.regexp_replace(F.lower(c), NON_LETTER_RUN, " "))
    s = F.concat(F.lit(" "), words, F.lit(" "))
    return F.regexp_extract_all(s, F.lit(TRIGRAM_WINDOW), 1)


def words(text: Column | str) -> Column:
    """Array of the lower-case letter words of a text (no empty entries)."""
    c = F.col(text) if isinstance(text, str) else text
    parts = F.split(F.trim(F.regexp_replace(F.lower(c), NON_LETTER_RUN, " ")), " ")
    return F.filter(parts, lambda w: w != F.lit(""))


def word_trigrams(word: Column) -> Column:
    """The trigrams of one entry of ``words``."""
    return F.regexp_extract_all(F.concat(F.lit(" "), word, F.lit(" ")), F.lit(TRIGRAM_WINDOW), 1)


def word_counts(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, word, c``: occurrences of each word in the labelled texts."""
    return documents.where(F.col(lang_col).isNotNull()) \
        .select(F.col(lang_col).alias("lang"), F.explode(words(text_col)).alias("word")) \
        .groupBy("lang", "word").agg(F.count(F.lit(1)).alias("c"))


def train_profiles(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, gram, n``: trigram counts per language.

    Trigrams never cross a word, so the corpus is first reduced to
    ``(lang, word) -> count`` (partial aggregation map-side), and only the
    distinct words are cut into trigrams: ``n = sum(count * occurrences)``.
    """
    grams = word_counts(documents, text_col, lang_col).select("lang", "c", F.explode(trigrams("word")).alias("gram"))
    return grams.groupBy("lang", "gram").agg(F.sum("c").alias("n"))


def language_norms(profiles: DataFrame) -> list[tuple[str, float]]:
    """``(lang, norm2)`` per language, collected: one row per label of the training corpus."""
    norms = profiles.groupBy("lang").agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("norm2"))
    return sorted((r["lang"], r["norm2"]) for r in norms.collect())


def training_vocabulary(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``word``: the distinct words of the labelled corpus (the words whose
    trigrams make up the profiles)."""
    return documents.where(F.col(lang_col).isNotNull()) \
        .select(F.explode(words(text_col)).alias("word")).distinct()


def per_gram_counts(profiles: DataFrame, langs: list[str]) -> DataFrame:
    """``gram, n0 .. nk``: the profile pivoted to one row per trigram."""
    return profiles.groupBy("gram").agg(*[
        F.coalesce(F.sum(F.when(F.col("lang") == F.lit(lang), F.col("n"))), F.lit(0)).alias(f"n{i}")
        for i, lang in enumerate(langs)])


def word_scores(vocabulary: DataFrame, per_gram: DataFrame, k: int) -> DataFrame:
    """``word, d0 .. dk``: for every word, the sum of its trigrams' profile
    counts in each language.  Words that share no trigram with any profile
    are left out (they add nothing)."""
    grams = vocabulary.select("word", F.explode(trigrams("word")).alias("gram"))
    return grams.join(per_gram, "gram").groupBy("word").agg(
        *[F.sum(f"n{i}").alias(f"d{i}") for i in range(k)])


def grams_of_word(word: str) -> list[str]:
    """``word_trigrams`` of one word, outside a plan.

    Java's matcher goes by UTF-16 units, so in a word with characters of two units windows begin at the second unit too."""
    padded = f" {word} "
    if max(padded) <= "\uffff":
        return [padded[i:i + GRAM] for i in range(len(padded) - GRAM + 1)]
    units = np.frombuffer(padded.encode("utf-16-le"), dtype="<u2").tolist()
    wide = lambda i: 0xD800 <= units[i] < 0xDC00 and i + 1 < len(units)
    found = []
    for start in range(len(units)):
        at, gram = start, ""
        while at < len(units) and len(gram) < GRAM:
            step = 2 if wide(at) else 1
            one = chr(0x10000 + ((units[at] - 0xD800) << 10) + units[at + 1] - 0xDC00) if step == 2 else "?" if 0xD800 <= units[at] < 0xE000 else chr(units[at])
            gram, at = gram + one, at + step
        if len(gram) == GRAM and gram[1] != " ":
            found.append(gram)
    return found


def _sums(grams: dict[str, tuple[int, ...]], kept: dict[str, np.ndarray], words: list[str], k: int) -> np.ndarray:
    """For each word the sums of its trigrams' counts by language."""
    if len(kept) > KEPT_WORDS:
        kept.clear()
    out = np.zeros((len(words), k), dtype=np.int64)
    for row, word in enumerate(words):
        found = kept.get(word)
        if found is None:
            known = [grams[g] for g in grams_of_word(word) if g in grams] if word else []
            found = kept[word] = np.array(known, dtype=np.int64).sum(axis=0) if known else np.zeros(k, dtype=np.int64)
        out[row] = found
    return out


def send(per_gram: DataFrame, k: int) -> Broadcast:
    """The counts of each trigram, for the tasks.  ``per_gram`` is collected: it holds at most ``INLINE_COUNTS`` counts."""
    counts = {r[0]: tuple(r[1:]) for r in per_gram.select("gram", *[f"n{i}" for i in range(k)]).collect()}
    return per_gram.sparkSession.sparkContext.broadcast(counts)


def with_dots(texts: DataFrame, per_gram: DataFrame | Broadcast, k: int, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows (their columns ``keep``; default: all) with ``d0 .. dk``: for every language the sum of its counts over the text's trigrams (0: none is known).

    The letters are told from other characters by Spark, and the tasks add up the words a batch of texts at a time, each
    distinct word once.  ``per_gram`` is a table or what ``send`` made of it."""
    ship_package(texts.sparkSession)
    sent = per_gram if isinstance(per_gram, Broadcast) else send(per_gram, k)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, kept = sent.value, {}
        for batch in batches:
            words = pc.split_pattern(batch.column(batch.num_columns - 1), " ")
            coded = words.values.dictionary_encode()
            codes, sums = coded.indices.to_numpy(zero_copy_only=False), _sums(grams, kept, coded.dictionary.to_pylist(), k)
            ends = words.offsets.to_numpy()
            full = np.flatnonzero(ends[1:] > ends[:-1])
            dots = []
            for i in range(k):
                dot = np.zeros(batch.num_rows, dtype=np.int64)
                if len(full):
                    dot[full] = np.add.reduceat(sums[:, i][codes], ends[:-1][full])
                dots.append(pa.array(dot))
            names = [*batch.schema.names[:-1], *[f"d{i}" for i in range(k)]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *dots], names=names)

    letters = F.trim(F.regexp_replace(F.lower(F.col(text_col)), NON_LETTER_RUN, " "))
    keep = keep or texts.columns
    schema = StructType([*texts.select(*keep).schema.fields, *[StructField(f"d{i}", LongType()) for i in range(k)]])
    return texts.select(*keep, letters.alias("letters of the text")).mapInArrow(add, schema)


def nearest(languages: list[tuple[str, float]]) -> Column:
    """The language of the largest cosine, of columns ``d0 .. dk``; null if no trigram is known.

    A known trigram has a count in some language."""
    scores = [F.struct((F.coalesce(F.col(f"d{i}"), F.lit(0)).cast("double") / F.sqrt(F.lit(norm2))).alias("score"), F.lit(lang).alias("lang"))
              for i, (lang, norm2) in enumerate(languages)]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return F.when(best["score"] > 0, best["lang"])


def _narrow(per_gram: DataFrame, k: int) -> bool:
    return per_gram.count() * k <= INLINE_COUNTS


def english_texts(texts: DataFrame, profiles: DataFrame, vocabulary: DataFrame, english: str = "en") -> DataFrame:
    """The rows (``id, text``) of the ids that ``detect`` takes for English.

    Rows and sums are stored in one pass over the texts.  The sums of an id that comes once are the row's own; only ids that
    come again are added up and joined, so that texts are not shuffled to meet their ids."""
    profiles = stored(profiles, "profiles")
    languages = language_norms(profiles)
    k = len(languages)
    per_gram = stored(per_gram_counts(profiles, [lang for lang, _ in languages]), "profile-grams") if k else None
    if per_gram is None or not _narrow(per_gram, k):
        rows = stored(texts.select("id", "text"), "archive")
        return rows.join(english_ids(detect(rows, profiles, vocabulary), english), "id", "left_semi")
    rows = stored(with_dots(texts.select("id", "text").where(F.col("id").isNotNull()), per_gram, k), "archive")
    sums = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n"), *[F.sum(f"d{i}").alias(f"d{i}") for i in range(k)])
    again = stored(sums.where("n > 1").select("id", (nearest(languages) == english).alias("chosen")), "repeated-ids")
    once = rows.join(again, "id", "left_anti").where(nearest(languages) == english)
    return once.select("id", "text").unionByName(rows.join(again.where("chosen"), "id", "left_semi").select("id", "text"))


def detect(texts: DataFrame, profiles: DataFrame, vocabulary: DataFrame,
           id_col: str = "id", text_col: str = "text") -> DataFrame:
    """``id, lang``: the nearest language of every text that shares at least
    one trigram with some profile.

    The texts are read once.  With profiles of up to ``INLINE_COUNTS`` counts each text is added up
    in its row, and rows of one id are added up after that.

    With larger profiles a word takes its scores from the table of the
    training words (``vocabulary``), and a word outside it is cut into trigrams
    on the spot and scored against the per-gram profile, so the per-post sums
    equal the sums over the post's trigram occurrences and no table grows with
    the posts.  Both tables are stored first: Spark knows their bytes and
    broadcasts them under its threshold, else joins by shuffle.
    """
    profiles = stored(profiles, "profiles")
    langs = language_norms(profiles)
    k = len(langs)
    if not k:
        return texts.select(F.col(id_col).alias("id"), F.lit(None).cast("string").alias("lang")).where(F.lit(False))
    per_gram = stored(per_gram_counts(profiles, [l for l, _ in langs]), "profile-grams")
    if _narrow(per_gram, k):
        rows = with_dots(texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), per_gram, k, keep=["id"])
        dots = rows.groupBy("id").agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(k)])
        return dots.select("id", nearest(langs).alias("lang")).where(F.col("lang").isNotNull())
    table = stored(word_scores(vocabulary, per_gram, k), "profile-words")
    post_words = texts.select(F.col(id_col).alias("id"), F.explode(words(text_col)).alias("word"))
    known = post_words.join(table, "word", "left")
    # Words missing from the table: their trigrams, scored against the profile.
    unknown_grams = F.when(F.col("d0").isNull(), trigrams("word"))
    rows = known.select("id", *[f"d{i}" for i in range(k)], F.explode_outer(unknown_grams).alias("gram"))
    rows = rows.join(per_gram, "gram", "left")
    dots = rows.groupBy("id").agg(*[
        F.sum(F.coalesce(F.col(f"d{i}"), F.col(f"n{i}"))).alias(f"d{i}") for i in range(k)]) \
        .where(F.coalesce(*[F.col(f"d{i}") for i in range(k)], F.lit(None)).isNotNull())
    return dots.select("id", nearest(langs).alias("lang"))


def english_ids(detected: DataFrame, english: str = "en") -> DataFrame:
    return detected.where(F.col("lang") == english).select("id")
