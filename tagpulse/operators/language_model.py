"""The language profiles as a stored model, asked row by row (L1, F4 (b)).

``save`` trains the profiles of ``operators.language`` on labelled texts and writes them as a new version: a row
for each trigram with its count in every language, and the same sums for the most frequent words.  ``load``
gives the newest version (or a given one).  ``detect`` and ``english`` send the trigrams to the tasks once for each loaded model, and
the tasks add up a batch of texts at a time, each distinct word once (``language.with_dots``).  There is no explode, no group-by and
no exchange, so a batch and a micro-batch are served alike, and English is a filter of the scan's rows instead of a semi-join.

``LanguageModel.language`` is the same answer as a column of an expression of any kind: a text's words are looked up in a hash table that
is a constant of the plan, words outside it are cut into trigrams that are looked up likewise.  Its lambdas run outside of compiled
code, which takes some ten times as long.  A slot of a table holds the keys that hash there, and the key itself is compared.

All answers are those of ``language.detect``, to the bit.  Models of up to ``INLINE_COUNTS`` trigrams times languages are sent or folded
into the plan; the size is counted when the model is saved.  Larger ones stay tables and ``detect`` joins them by trigram.

Defined results: a null or empty text, or one that shares no trigram with a profile, has no language (null);
ties go to the larger code; a model without languages knows none.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.operators import language as L
from tagpulse.session import delete_path, stored
from tagpulse.sinks import manifest

#: Counts (trigrams times languages) of the largest model that is folded into a plan, about 10 MB.
INLINE_COUNTS = 1_000_000
#: Counts (words times languages) of the frequent words that are looked up whole; others are cut into trigrams, with the same result.
FREQUENT_COUNTS = 60_000
#: Versions that stay for running readers.
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class LanguageModel:
    """A stored version: its languages with their squared norms, its trigrams ``key, n0 .. nk``, and the most frequent
    training words with the sums of their trigrams, alike."""

    version: int
    languages: tuple[tuple[str, float], ...]
    grams: DataFrame
    words: DataFrame
    n_grams: int
    n_words: int
    _constants: dict = field(default_factory=dict, compare=False, repr=False)

    @property
    def narrow(self) -> bool:
        return self.n_grams * len(self.languages) <= INLINE_COUNTS

    def _table(self, name: str) -> Column:
        """The trigrams or words by slot, as a constant.  What is collected was counted to be small when the model was saved."""
        frame, slots = (self.grams, self.n_grams) if name == "grams" else (self.words, self.n_words)
        if name not in self._constants:
            counts = F.array(*[f"n{i}" for i in range(len(self.languages))])
            table: list[list[dict]] = [[] for _ in range(slots)]
            for row in frame.select(F.pmod(F.xxhash64("key"), F.lit(slots)).alias("slot"), "key", counts.alias("n")).collect():
                table[row["slot"]].append({"k": row["key"], "n": row["n"]})
            self._constants[name] = json.dumps(table, ensure_ascii=False, separators=(",", ":"))
        return F.from_json(F.lit(self._constants[name]), "array<array<struct<k:string,n:array<bigint>>>>")

    def _look_up(self, name: str):  # noqa: ANN202
        """The counts of a key (null: not in the table), as a function of its column."""
        slots = self.n_grams if name == "grams" else self.n_words
        if not slots:
            return lambda key: F.lit(None).cast("array<bigint>")
        table = self._table(name)
        return lambda key: F.get(F.filter(F.get(table, F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")), lambda e: e["k"] == key), 0)["n"]

    def _sum(self, counts: Column, finish) -> Column:  # noqa: ANN001
        """``finish`` of the sums by language of an array of counts."""
        k = range(len(self.languages))
        none = F.struct(*[F.lit(0).cast("long").alias(f"d{i}") for i in k])
        return F.aggregate(counts, none, lambda d, n: F.struct(*[(d[f"d{i}"] + F.coalesce(F.get(n, i), F.lit(0))).alias(f"d{i}") for i in k]),
                           lambda d: finish([d[f"d{i}"] for i in k]))

    def language(self, text: Column | str) -> Column:
        """The nearest language of a text (null: none), in the row."""
        if not self.narrow:
            raise ValueError("the model is too large for a column: detect")
        if not self.languages or not self.n_grams:
            return F.lit(None).cast("string")
        of_word, of_gram = self._look_up("words"), self._look_up("grams")

        def counts(word: Column) -> Column:
            return F.coalesce(of_word(word), self._sum(F.transform(L.word_trigrams(word), of_gram), lambda d: F.array(*d)))

        return self._sum(F.transform(L.words(text), counts), self._nearest)

    def _nearest(self, dots: list[Column]) -> Column:
        """The language of the largest cosine; a known trigram has a count in some language, so a score of 0 means that none was known."""
        scores = [F.struct((dot.cast("double") / F.sqrt(F.lit(norm2))).alias("score"), F.lit(lang).alias("lang"))
                  for dot, (lang, norm2) in zip(dots, self.languages, strict=True)]
        none = F.struct(F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("lang"))
        return F.aggregate(F.array(*scores), none, lambda best, score: F.greatest(best, score), lambda best: F.when(best["score"] > 0, best["lang"]))

    def _rows(self, texts: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
        """The columns ``keep`` and ``nearest``, the language of each text; the trigrams are sent once."""
        k = len(self.languages)
        if not k or not self.n_grams:
            return texts.select(*keep, F.lit(None).cast("string").alias("nearest"))
        if "sent" not in self._constants:
            self._constants["sent"] = L.send(self.grams.withColumnRenamed("key", "gram"), k)
        dots = L.with_dots(texts, self._constants["sent"], k, text_col, keep)
        return dots.select(*keep, self._nearest([F.col(f"d{i}") for i in range(k)]).alias("nearest"))

    def detect(self, texts: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
        """``id, lang`` of the texts that have a language: in the row, or joined by trigram if the model is large."""
        if self.narrow:
            found = self._rows(texts.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", ["id"])
            return found.where(F.col("nearest").isNotNull()).select("id", F.col("nearest").alias("lang"))
        k = len(self.languages)
        occurrences = texts.select(F.col(id_col).alias("id"), F.explode(L.trigrams(text_col)).alias("gram"))
        counted = occurrences.groupBy("id", "gram").agg(F.count(F.lit(1)).alias("c"))
        dots = counted.join(self.grams.withColumnRenamed("key", "gram"), "gram").groupBy("id").agg(*[F.sum(F.col("c") * F.col(f"n{i}")).alias(f"d{i}") for i in range(k)])
        return dots.select("id", self._nearest([F.col(f"d{i}") for i in range(k)]).alias("lang"))

    def english(self, posts: DataFrame, text_col: str = "text", english: str = "en") -> DataFrame:
        """F4 (b): the posts whose nearest language is English; a filter of rows if the model is sent to the tasks."""
        if self.narrow:
            return self._rows(posts, text_col, posts.columns).where(F.col("nearest") == F.lit(english)).select(*posts.columns)
        return posts.join(L.english_ids(self.detect(posts, text_col=text_col), english), "id", "left_semi")


def save(spark: SparkSession, path: str, documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> int:
    """Train on labelled texts and make the profiles the newest version of the model at ``path``; returns its number.

    The rows are written before the manifest is committed, so a reader sees a whole version or the one before."""
    profiles = stored(L.train_profiles(documents, text_col, lang_col), "model-profiles")
    languages = L.language_norms(profiles)
    k, folder = len(languages), f"{path}/data/{uuid.uuid4().hex}"
    grams = stored(L.per_gram_counts(profiles, [lang for lang, _ in languages]) if k else profiles.select("gram"), "model-grams")
    grams.withColumnRenamed("gram", "key").write.parquet(f"{folder}/grams")
    frequent = L.word_counts(documents, text_col, lang_col).groupBy("word").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "word").limit(FREQUENT_COUNTS // max(1, k))
    scored = L.word_scores(frequent, grams, k) if k else frequent
    scored.select(F.col("word").alias("key"), *[F.col(f"d{i}").alias(f"n{i}") for i in range(k)]).write.parquet(f"{folder}/words")
    found = manifest.versions(spark, path)
    version = found[-1] + 1 if found else 0
    manifest.commit(spark, path, version, {
        "folder": folder, "languages": languages, "grams": grams.count(), "words": spark.read.parquet(f"{folder}/words").count()})
    for old in manifest.forget(spark, path, KEPT_VERSIONS):
        delete_path(spark, old["folder"])
    return version


def load(spark: SparkSession, path: str, version: int | None = None) -> LanguageModel:
    """The newest version of a stored model, or a given one."""
    found = manifest.read(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no language model at {path}")
    number, body = found
    schema = ", ".join(["key string"] + [f"n{i} bigint" for i in range(len(body["languages"]))])
    grams, words = (spark.read.schema(schema).parquet(f"{body['folder']}/{name}") for name in ("grams", "words"))
    return LanguageModel(number, tuple((lang, float(norm2)) for lang, norm2 in body["languages"]), grams, words, body["grams"], body["words"])
