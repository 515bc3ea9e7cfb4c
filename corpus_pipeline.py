"""From raw documents to packed training bins, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; what it
returns is written as Parquet in the shared folder and read again for the next.  All but the
last return the columns of ``documents``.

A null id, text or source is carried through.  Rows with the same id are one document to the join and stay
together.  An empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.llm import bestfit, mixing, ngram_join, substring, toxicity
from tagpulse.llm.common import materialize, table

#: Near duplicates: five-word shingles, a likeness of 0.8.
SHINGLE_WORDS, LIKENESS_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the passage model scores below one half; it learns from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(toxicity.fold(F.col("doc_id")) != 0)
    return toxicity.reject(docs, toxicity.learn(docs, labels))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near duplicates, the document of the smallest id."""
    found = ngram_join.linked(docs, SHINGLE_WORDS, LIKENESS_PERCENT)
    gone = materialize(found.where("component_id <> doc_id").select("doc_id").distinct(), "near-duplicates")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 35 words or more that occur more than once, with their new length."""
    done = substring.cut(docs, substring.kept_text, "kept", keep=docs.columns)
    own = {c: F.col(f"row.`{c}`") for c in docs.columns}
    text = F.when(own["text"].isNotNull(), F.col("kept"))
    n_chars = F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(own["n_chars"])
    return done.select(*[c.alias(name) for name, c in (own | {"text": text, "n_chars": n_chars}).items()])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of each document, with its bin."""
    return bestfit.best_fit(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: A trained classifier and a sequential packing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
