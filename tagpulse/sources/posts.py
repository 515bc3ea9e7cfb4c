"""Posts derived, deterministically, from the ``events`` and ``documents`` tables.

The driver's tables carry no social posts, so the input of every layer is
built from them in Spark (and the same rule in SQL for the oracle):

* ``id``      = ``event_id`` as a string
* ``lang``    = language of document ``event_id % count(documents)``
* ``text``    = a leading ``#<event_type> `` when ``k % 10 = 0`` (position 0,
  so it must not count as a hashtag) + the whole document text + polarity
  words chosen by ``k % 4`` + ``none`` when ``k % 10`` is 0 or 1, otherwise
  ``#<event_type> #extra``
* ``created`` = ``ts`` rendered like ``Date.toString()`` in UTC

``k`` is ``$.k`` of ``events.props``.  ``raw_posts`` is the text as it would
come from the social API; ``posts`` applies the ingest normalisation (P1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.functions.text import made_once, normalize_text
from tagpulse.functions.timeparse import render_created
from tagpulse.sources.tables import read_table

# --- fixed values of the derivation (shared with the SQL twin) --------------
POLARITY_WORDS = {0: " good great ", 1: " bad trash ", 2: " good stupid ", 3: " like good "}
NO_TAG_TAIL = "none"
EXTRA_TAG = " #extra"
# ---------------------------------------------------------------------------


def raw_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, lang, text, created`` before ingest normalisation.

    The document count is a scalar subquery evaluated once by Spark; the
    event -> document lookup is a sort-merge equi-join on the computed key.
    """
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "props")
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    n_docs = documents.select(F.count(F.lit(1))).scalar()

    k = F.get_json_object("props", "$.k").cast("long")
    keyed = events.select(
        F.col("event_id"), F.col("ts"), F.col("event_type"),
        k.alias("k"),
        (F.col("event_id") % n_docs).alias("doc_id"),
    )
    polarity = F.lit(POLARITY_WORDS[3])
    for residue in (2, 1, 0):
        polarity = F.when(F.col("k") % 4 == residue, F.lit(POLARITY_WORDS[residue])).otherwise(polarity)
    tag = F.concat(F.lit("#"), F.col("event_type"))
    text = F.concat(
        F.when(F.col("k") % 10 == 0, F.concat(tag, F.lit(" "))).otherwise(F.lit("")),
        F.col("text"),
        polarity,
        F.when((F.col("k") % 10).isin(0, 1), F.lit(NO_TAG_TAIL)).otherwise(F.concat(tag, F.lit(EXTRA_TAG))),
    )
    # Both tables grow with the data, so this is a shuffle join at scale; the
    # hint keeps it one at small scale too (a broadcast of ``events`` would
    # stream the single-split ``documents`` scan through one task).  A sort-merge
    # join spills, and splits a hot document, where a hash build could do neither.
    return keyed.hint("merge").join(documents, "doc_id").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("lang"),
        text.alias("text"),
        render_created("ts").alias("created"),
    )


def normalize_posts(raw: DataFrame) -> DataFrame:
    """Ingest normalisation of ``text`` and ``created``; other columns pass.

    The text is made once: the filters and columns that follow would each build it again."""
    others = [c for c in raw.columns if c not in ("text", "created")]
    return made_once(raw.select(*others, "text", normalize_text("created").alias("created")), "text", normalize_text("text"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised posts ``id, lang, text, created``."""
    return normalize_posts(raw_posts(spark, sf_dir))
