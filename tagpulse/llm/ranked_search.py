"""Ranked lexical search with bag deduplication.

Only the items' terms can score, so a document is reduced to its *bag*: the times of each item term in it, and the length
normaliser ``m``.  Documents of equal bag and ``m`` score alike for every item; they are one class, which is scored once.

1. The items' terms are numbered.  Items go in blocks of about ``BLOCK`` (item, term) rows, so what is broadcast has that size
   whatever the number of items; one block is one pass over the documents.
2. A scan gives each document's number of terms and its bag (packed numbers).  Sums of these rows give N, L and each term's df.
3. Classes are groups by the bag and ``m`` themselves, behind their hash: equal hashes alone merge nothing.  Copies collapse in the
   map-side aggregation.
4. Each task scores its classes by the items' posting lists and keeps, for each item, the best ``k`` by score and then by
   the smallest doc_id of the class.  Every class ahead holds a document ahead of all documents of a later class, so
   the k best documents are in the k best classes.
5. The chosen classes are joined back to the documents, again by hash and then by bag and ``m``; of each the first ``k`` in
   ascending doc_id are ranked.

All scores are 64-bit integers, so results don't depend on the order of sums.

Defined results: a null or empty text has no term; a document without an id counts in N, L and df but can't be ranked; rows with
the same id are documents of their own; equal scores go by ascending doc_id; an item without terms, or whose terms are nowhere,
has no rows; each row of the items is an item, rows with the same item_id too; texts of any length are read whole; empty tables
give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.llm.common import materialize
from tagpulse.llm.tokens import LOWER, gathered, runs, text_bytes
from tagpulse.llm.words import NOT_ALNUM, run_hashes, signed
from tagpulse.session import ship_package

#: (item, term) rows of a block of items.
BLOCK = 1 << 20
#: Bytes of text, and scores, that a task holds at once.
CHUNK, MATRIX = 4 << 20, 1 << 21
K = 20


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all rows' terms in order, and each row's first (the end included)."""
    data, rows = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = runs(~NOT_ALNUM[data], rows)
    return run_hashes(data, starts, ends), first


def _counted(rows: np.ndarray, terms: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct (row, term) pairs in order, and how often each occurs."""
    pairs, times = np.unique(rows * n_terms + terms, return_counts=True)
    return pairs // n_terms, pairs % n_terms, times


def item_terms(items: DataFrame) -> DataFrame:
    """``item, term, times`` of ``item, text`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, CHUNK, 1):
            hashes, first = term_hashes(batch.column(1))
            distinct, which = np.unique(hashes, return_inverse=True)
            row, term, times = _counted(np.repeat(np.arange(len(first) - 1), np.diff(first)), which, max(1, len(distinct)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(signed(distinct)[term]), pa.array(times)],
                                             ["item", "term", "times"])

    return items.mapInArrow(run, "item bigint, term bigint, times bigint")


def bags(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``doc_id, n, bag`` of ``doc_id, text`` rows: all terms counted, and the packed (number, times) of those in ``terms``."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in gathered(batches, CHUNK, 1):
            hashes, first = term_hashes(batch.column(1))
            spot = np.minimum(np.searchsorted(wanted, hashes), max(0, len(wanted) - 1))
            found = np.flatnonzero(wanted[spot] == hashes) if len(wanted) else np.empty(0, np.int64)
            row, term, times = _counted(np.repeat(np.arange(batch.num_rows), np.diff(first))[found], spot[found], max(1, len(wanted)))
            packed = np.stack([term, times], 1).astype("<u4").tobytes()
            ends = 8 * np.searchsorted(row, np.arange(batch.num_rows + 1))
            bag = pa.array([packed[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first).astype(np.int64)), bag], ["doc_id", "n", "bag"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, bag binary")


def _bag_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The (number, times) pairs of all bags, and how many each has."""
    blobs = column.to_pylist()
    pairs = np.frombuffer(b"".join(blobs), "<u4").reshape(-1, 2).astype(np.int64)
    return pairs, np.fromiter((len(b) // 8 for b in blobs), np.int64, len(blobs))


def document_frequency(rows: DataFrame, n_terms: int) -> np.ndarray:
    """In how many bags each term is; a task sends one number for each of its terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(_bag_rows(batch.column(0))[0][:, 0], minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in rows.select("bag").mapInArrow(run, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


@dataclass(frozen=True)
class Items:
    """A block's items as posting lists: term ``t`` has entries ``first[t]:first[t + 1]`` of (item, its weight times repeats)."""

    ids: np.ndarray
    first: np.ndarray
    item: np.ndarray
    weight: np.ndarray


def class_scores(items: Items, m: np.ndarray, pairs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The scores of some classes (rows) for all items (columns)."""
    row = np.repeat(np.arange(len(m)), sizes)
    term, tf = pairs[:, 0], pairs[:, 1]
    impact = (1_000_000_000 * tf) // (1000 * tf + 12 * m[row])
    times = items.first[term + 1] - items.first[term]
    upto = np.cumsum(times)
    entry = np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - times - items.first[term], times)
    out = np.zeros(len(m) * len(items.ids), np.int64)
    np.add.at(out, np.repeat(row * len(items.ids), times) + items.item[entry], np.repeat(impact, times) * items.weight[entry])
    return out.reshape(len(m), len(items.ids))


def best_classes(classes: DataFrame, items: Items, k: int) -> DataFrame:
    """``item, score, first, class`` of each task's ``k`` best classes of each item."""
    shared = classes.sparkSession.sparkContext.broadcast(items)

    def kept(held: np.ndarray) -> np.ndarray:
        """The best k of each item; columns: item, score, first, class."""
        held = held[np.lexsort((held[:, 2], -held[:, 1], held[:, 0]))]
        start = np.searchsorted(held[:, 0], held[:, 0])
        return held[np.arange(len(held)) - start < k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        held, least = np.empty((0, 4), np.int64), np.ones(len(items.ids), np.int64)
        for batch in batches:
            ids, first, m = (batch.column(i).to_numpy() for i in range(3))
            pairs, sizes = _bag_rows(batch.column(3))
            ends = np.cumsum(sizes)
            work = np.cumsum(np.diff(items.first)[pairs[:, 0]])[ends - 1]
            lo = 0
            while lo < len(m):
                done = work[lo - 1] if lo else 0
                hi = min(int(np.searchsorted(work, done + MATRIX, "right")), lo + max(1, MATRIX // len(items.ids)))
                hi = max(hi, lo + 1)
                scores = class_scores(items, m[lo:hi], pairs[ends[lo] - sizes[lo]:ends[hi - 1]], sizes[lo:hi])
                c, i = np.nonzero(scores >= least)
                if len(c):
                    held = kept(np.concatenate([held, np.stack([i, scores[c, i], first[lo:hi][c], ids[lo:hi][c]], 1)]))
                    full = np.flatnonzero(np.bincount(held[:, 0], minlength=len(least)) >= k)
                    last = np.searchsorted(held[:, 0], full, "right") - 1
                    least[full] = held[last, 1]
                lo = hi
        yield pa.RecordBatch.from_arrays([pa.array(items.ids[held[:, 0]]), *[pa.array(held[:, j]) for j in (1, 2, 3)]], ["item", "score", "first", "class"])

    return classes.select("class", "first", "m", "bag").mapInArrow(run, "item bigint, score bigint, first bigint, class bigint")


def _ranked(rows: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """``item, doc_id, score, rank`` for a block's ``item, term, times`` rows."""
    rows = np.array([tuple(r) for r in rows], np.int64).reshape(-1, 3)
    ids, item = np.unique(rows[:, 0], return_inverse=True)
    terms, term = np.unique(rows[:, 1].view(np.uint64), return_inverse=True)
    found = materialize(bags(docs, terms), "search-bags")
    n_docs, length = found.where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequency(found, len(terms))
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    order = np.argsort(term, kind="stable")
    items = Items(ids, np.searchsorted(term[order], np.arange(len(terms) + 1)), item[order], (weight[term] * rows[:, 2])[order])

    m = F.expr(f"{100 - 25} + (25 * n * {n_docs}L) div {max(1, length)}L")
    named = found.where("length(bag) > 0 and doc_id is not null").select("doc_id", m.alias("m"), "bag").withColumn("class", F.xxhash64("m", "bag"))
    classes = materialize(named.groupBy("class", "m", "bag").agg(F.min("doc_id").alias("first")), "search-classes")
    best = _ranked(best_classes(classes, items, k), ["item"], [F.desc("score"), F.asc("first")], k)
    best = materialize(best.select("item", "score", "first", "class"), "search-best")
    chosen = materialize(classes.join(best.select("class", "first").distinct(), ["class", "first"]), "search-chosen")
    members = _ranked(named.join(chosen, ["class", "m", "bag"]).select("class", "first", "doc_id"), ["class", "first"], [F.asc("doc_id")], k)
    return _ranked(best.join(members.drop("rank"), ["class", "first"]), ["item"], [F.desc("score"), F.asc("doc_id")], k)


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents (``doc_id, text``) of each item (``item_id, text``)."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    numbered = materialize(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text"), "search-items")
    terms = materialize(item_terms(numbered.select("item", "text")), "search-terms")
    blocks = max(1, -(-terms.count() // block))
    block_of = F.pmod(F.xxhash64("item"), F.lit(blocks))
    parts = [_search_block(docs, terms.where(block_of == b).collect(), k) for b in range(blocks)]
    found = reduce(DataFrame.unionByName, parts)
    return found.join(numbered.select("item", "item_id"), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


_TERMS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")


def search_sql(k: int = K) -> str:
    """The same result as DuckDB SQL, by scoring every document that shares a term."""
    return rf"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS len FROM lengths),
wanted AS (SELECT item_id, term, count(*)::BIGINT AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, corpus GROUP BY term),
normal AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // len)::BIGINT AS m FROM lengths, corpus),
scores AS (
  SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN normal USING (doc_id) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM scores WHERE score > 0)
SELECT item_id, r::INTEGER AS rank, doc_id, score FROM ranked WHERE r <= {k}
"""
