"""Word lists (stop / positive / negative) and how they reach the plan.

A lexicon is an input with a path, one word per line, taken verbatim.  Small
lexicons are folded into the plan as ``isin`` literals (hash INSET, no
shuffle); the size is counted before anything is collected.  Larger ones stay
tables (``LexiconTable``), which the operators join by word.
"""

from __future__ import annotations

from dataclasses import dataclass
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.schemas import LEXICON

STOP, POSITIVE, NEGATIVE = "stop", "positive", "negative"
CATEGORIES = (STOP, POSITIVE, NEGATIVE)

# Up to this many distinct words per category are folded into the plan.
INLINE_WORDS = 50_000


@dataclass(frozen=True)
class Lexicon:
    stop: tuple[str, ...]
    positive: frozenset[str]
    negative: frozenset[str]

    def words(self, category: str):
        return {STOP: self.stop, POSITIVE: self.positive, NEGATIVE: self.negative}[category]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(w, c) for c in CATEGORIES for w in sorted(set(self.words(c)))]
        return spark.createDataFrame(rows, LEXICON)


@dataclass(frozen=True)
class LexiconTable:
    """A lexicon of any size as ``(word, category)`` rows."""

    frame: DataFrame

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return self.frame


def _packaged(name: str) -> list[str]:
    text = resources.files("tagpulse.resources.lexicon").joinpath(f"{name}.txt").read_text("utf-8")
    return text.splitlines()


def default_lexicon() -> Lexicon:
    """The short lists shipped with the package (our own words)."""
    return Lexicon(
        stop=tuple(_packaged(STOP)),
        positive=frozenset(_packaged(POSITIVE)),
        negative=frozenset(_packaged(NEGATIVE)),
    )


def lexicon_frame(spark: SparkSession, stop_path: str, positive_path: str,
                  negative_path: str) -> DataFrame:
    """The three lists as one ``(word, category)`` DataFrame, distinct.

    Lines are kept verbatim (no trim, no case folding), as in the original.
    """
    parts = [
        spark.read.text(path).select(F.col("value").alias("word"), F.lit(cat).alias("category"))
        for cat, path in ((STOP, stop_path), (POSITIVE, positive_path), (NEGATIVE, negative_path))
    ]
    frame = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return frame.where(F.col("word") != "").distinct()


def load_lexicon(spark: SparkSession, stop_path: str, positive_path: str, negative_path: str,
                 inline_words: int = INLINE_WORDS) -> Lexicon | LexiconTable:
    """A lexicon to fold into the plan when it is counted to be small, else the table."""
    frame = lexicon_frame(spark, stop_path, positive_path, negative_path)
    sizes = frame.groupBy("category").agg(F.count("*").alias("n")).collect()
    if any(r["n"] > inline_words for r in sizes):
        return LexiconTable(frame)
    words = {c: [] for c in CATEGORIES}
    for row in frame.collect():
        words[row["category"]].append(row["word"])
    return Lexicon(stop=tuple(sorted(words[STOP])), positive=frozenset(words[POSITIVE]),
                   negative=frozenset(words[NEGATIVE]))


# --- a bit set of a lexicon ---------------------------------------------------------

#: Bits for each word, hash functions, and the largest bit set (2 MB) that is folded into a plan; beyond it more words pass by chance.
BITS_PER_WORD, BIT_HASHES, MOST_BITS = 32, 3, 1 << 24


@dataclass(frozen=True)
class WordBits:
    """A fixed-size bit set: a word of the lexicon always passes, another seldom (under 1 in 1,000 below ``MOST_BITS``)."""

    bits: int
    words: str

    def may_hold(self, word: Column) -> Column:
        table = F.from_json(F.lit(self.words), "array<bigint>")
        found = None
        for seed in range(BIT_HASHES):
            slot = F.pmod(F.xxhash64(word, F.lit(seed)), F.lit(self.bits))
            bit = F.get(table, F.shiftright(slot, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))) != 0
            found = bit if found is None else found & bit
        return found


def word_bits(words: DataFrame) -> WordBits:
    """The bit set of a column ``word``.  Its size follows the counted words up to ``MOST_BITS``; what is collected has that size."""
    words = words.select("word").distinct()
    n = words.count()
    bits = 64
    while bits < min(MOST_BITS, n * BITS_PER_WORD):
        bits *= 2
    slots = words.select(F.explode(F.array(*[F.pmod(F.xxhash64("word", F.lit(s)), F.lit(bits)) for s in range(BIT_HASHES)])).alias("slot"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("slot") % 64).cast("int"))
    table = [0] * (bits // 64)
    for row in slots.groupBy(F.shiftright("slot", 6).alias("i")).agg(F.bit_or(one).alias("w")).collect():
        table[row["i"]] = row["w"]
    return WordBits(bits, "[" + ",".join(map(str, table)) + "]")
