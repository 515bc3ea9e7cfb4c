"""The registered query of each operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.llm import (bestfit, cross_polytope, hash_ring, lm_scoring, mixing, ngram_join, pfor, ranked_search, spelling, spotsigs, substring, toxicity,
                          url_filter)
from tagpulse.llm.common import table
from tagpulse.session import scratch_path

SHARDS = 16
TOKENIZER = "byte_bpe_50k.json"


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents linked at a Jaccard likeness of 0.9 on three-word shingles."""
    return ngram_join.linked(table(spark, sf_dir, "documents"), n=3, percent=90)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the rules, and else against its host's tree of path templates.

    A page is a labelled example when the document that its path names is labelled; low quality or toxic is bad."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    marked = table(spark, sf_dir, "labels").select(
        "doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    _, path = url_filter.host_and_path(F.col("url"))
    number = F.expr("try_cast(doc AS bigint)")
    named = pages.withColumn("doc", F.regexp_extract(path, r"(\d+)(?:\.\w+)?/?$", 1)).select("page_id", number.alias("doc_id"))
    return url_filter.judge(pages, named.join(marked, "doc_id").select("page_id", "bad"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored for toxicity; rows whose checksum is a multiple of five are held out of learning."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = toxicity.fold(F.col("doc_id")) == 0
    model = toxicity.learn(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_passages", "best_passage", "evidence")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found of every fiftieth vector."""
    return cross_polytope.search(table(spark, sf_dir, "embeddings"), lambda key: key % 50 == 0)


def op6_pfor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written in blocks and read back."""
    import public_tokenizers
    path = scratch_path(spark, "token-ids")
    pfor.write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER))
    return pfor.read_checksums(spark, path)


def op7_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents on a ring of 16 shards whose counts differ by one at most."""
    return hash_ring.assign(table(spark, sf_dir, "documents"), SHARDS)


def op8_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into bins of 2,048 words."""
    return bestfit.best_fit(table(spark, sf_dir, "documents"))


def op9_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of windows of 35 words that occur more than once."""
    docs = table(spark, sf_dir, "documents")
    return substring.cut(docs, substring.kept_digest, "kept_sha256").select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the weights 5, 2, 1, at most three epochs of a source."""
    return mixing.shares(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of those whose checksum leaves no 2 modulo seven."""
    return lm_scoring.score(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of five letters and three occurrences with their near words' most frequent and root."""
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_ngram_join, op2_url_filter, op3_toxicity, op4_spotsigs, op5_cross_polytope, op6_pfor, op7_hash_ring, op8_best_fit, op9_substring, op10_mixing,
                              op11_ranked_search, op12_lm_scoring, op13_spelling)}

ORACLE_SQL: dict[str, str] = {"op1_ngram_join": ngram_join.linked_sql(3, 90), "op9_substring": substring.cut_sql(substring.WINDOW),
                              "op10_mixing": mixing.SHARES_SQL, "op11_ranked_search": ranked_search.search_sql()}
