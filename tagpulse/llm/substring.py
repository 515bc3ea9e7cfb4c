"""Substring deduplication by seed and extend: passages that occur more than once are cut.

A window is ``window`` consecutive words.  Windows are found by their anchor: among the ``SEED``-word seeds of
a window, the one of the smallest hash (winnowing).  Equal windows choose equal anchors at equal offsets.

1. Seed: the anchors of every text, each with its span, that is all windows that choose this occurrence, as one
   hash.  Anchors that occur once go.
2. Extend: occurrences of an anchor with equal spans match over their whole span, both ways.  Where an
   anchor's spans differ, one witness of each and every span of its own are extended window by window, and a
   window that two of them share is repeated.
3. The maximal repeats of a text are the unions of its repeated spans and windows; their words are cut.

Texts with equal words are repeated as a whole; a task sends the anchors of such a text once.  Counts are
pre-aggregated and joins split on a hot key, so a passage in a third of all documents costs a row for each
occurrence, never a pair.  Only texts that may hold a repeat are shuffled (a bitmap of fixed size tells).

Defined results: windows are judged on the input, and the first occurrence is cut like others.  A null text has no
words; texts shorter than a window are left alone.  A null id is an id; rows with the same id are told apart by their
words, and repeated rows are repeats of each other.  An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagpulse.llm.common import arrow_batches, discard, id_filter, id_slot, look_up, materialize
from tagpulse.llm.words import Chunk, Words, chunks, mix, signed, span_hashes, split_words, window_hashes

WINDOW = 35
SEED = 11
NO_ID = -(1 << 63)
_U = np.uint64
_TEXT = ["doc", "d1"]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the leftmost minimum of each ``width`` consecutive values."""
    at, have = np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        have += step
    return at


def anchors(words: Words, window: int, rows: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(row, first window, windows, anchor hash, span hash)`` of the anchors of the given rows of a chunk."""
    empty = np.empty(0, np.int64)
    seeds = window_hashes(words.hashes, SEED)
    if len(seeds) < window - SEED + 1:
        return empty, empty, empty, empty, empty
    at = sliding_argmin(seeds, window - SEED + 1)
    row_of = np.repeat(np.arange(len(words.first) - 1), words.counts())
    start = np.arange(len(at))
    use = (row_of[start] == row_of[start + window - 1]) & rows[row_of[start]]
    start, at = start[use], at[use]
    if not len(start):
        return empty, empty, empty, empty, empty
    head = np.ones(len(start), bool)
    head[1:] = (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(start)))
    s, p = start[first], at[first]
    span = mix(span_hashes(words.hashes, s, s + count + window - 1) + (p - s).astype(_U))
    row = row_of[s]
    return row, s - words.first[row], count, signed(seeds[p]), signed(span)


def _digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row's word sequence."""
    a, b = words.first[:-1], words.first[1:]
    return signed(span_hashes(words.hashes, a, b)), signed(span_hashes(mix(words.hashes), a, b))


_SCAN = "doc bigint, d1 bigint, d2 bigint, n bigint, s int, m int, a bigint, h bigint"


def _scan(texts: DataFrame, window: int) -> DataFrame:
    """A row for every text (``n``) and one for every anchor (``a``); a task gives the anchors of equal texts once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        names = ["doc", "d1", "d2", "n", "s", "m", "a", "h"]
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                words = split_words(chunk)
                doc, (d1, d2), n = batch.column(0).slice(chunk.lo, chunk.hi - chunk.lo), _digests(words), words.counts()
                rows = len(n)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array(d1), pa.array(d2), pa.array(n, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int32()),
                     pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], names)
                new = n >= window
                for r in np.flatnonzero(new).tolist():
                    digest = (int(d1[r]), int(d2[r]))
                    new[r] = digest not in seen
                    seen.add(digest)
                row, s, m, a, h = anchors(words, window, new)
                if len(row):
                    size = len(row)
                    yield pa.RecordBatch.from_arrays(
                        [doc.take(pa.array(row)), pa.array(d1[row]), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()), pa.array(s, pa.int32()),
                         pa.array(m, pa.int32()), pa.array(a), pa.array(h)], names)

    return texts.mapInArrow(run, _SCAN)


def _picked(texts: DataFrame, wanted: np.ndarray, columns: list[str]) -> DataFrame:
    """Texts whose id may be among the ``wanted`` ones, with ``d1``, and not shuffled yet."""
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(shared.value[id_slot(batch.column(0).to_numpy())]))
            d1 = [signed(span_hashes((w := split_words(c)).hashes, w.first[:-1], w.first[1:])) for c in chunks(batch.column(1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(d1) if d1 else np.empty(0, np.int64))], [*batch.schema.names, "d1"])

    rows = texts.select(*columns)
    return rows.mapInArrow(run, T.StructType([*rows.schema, T.StructField("d1", T.LongType())]))


def _windows(texts: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """``doc, d1, s, a, target, w``: the hash of each window of the spans asked for."""
    lists = asked.groupBy(*_TEXT).agg(F.collect_list(F.struct("s", "m", "a", "target")).alias("spans"))
    lists = materialize(lists, "sub-asked")
    rows = _picked(texts, id_filter(lists.select("doc")), ["doc", "text"]).join(lists, _TEXT).select("doc", "d1", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                words = split_words(chunk)
                hashes = window_hashes(words.hashes, window)
                for r in range(chunk.lo, chunk.hi):
                    base = words.first[r - chunk.lo]
                    spans = batch.column(3)[r].as_py()
                    m = np.array([x["m"] for x in spans])
                    s = np.repeat([x["s"] for x in spans], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                    size = len(s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, batch.column(0)[r].as_py())), pa.array(np.full(size, batch.column(1)[r].as_py())), pa.array(s, pa.int32()),
                         pa.array(np.repeat([x["a"] for x in spans], m), pa.int64()), pa.array(np.repeat([x["target"] for x in spans], m), pa.bool_()),
                         pa.array(signed(hashes[base + s]))], ["doc", "d1", "s", "a", "target", "w"])

    return rows.mapInArrow(run, "doc bigint, d1 bigint, s int, a bigint, target boolean, w bigint")


def repeats(texts: DataFrame, window: int) -> DataFrame:
    """``doc, d1, spans``: the repeated word ranges ``(from, to)`` of every text that has any; ``texts``: ``doc, text``."""
    scanned = materialize(_scan(texts.select("doc", "text"), window), "sub-scan")
    known = scanned.where("n is not null")
    classes = materialize(known.where(F.col("n") >= window).groupBy("d1", "d2", "n").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "sub-classes")
    whole = look_up(known.select("doc", "d1", "d2", "n"), classes, ["d1", "d2", "n"], "copies", max(1, known.count())).select(
        *_TEXT, F.lit(0).alias("from"), F.col("n").cast("int").alias("to"))

    found = scanned.where("a is not null").select("a", "h", "doc", "d1", "s", "m")
    often = materialize(found.groupBy("a").agg(F.count(F.lit(1)).alias("c"), F.min("h").alias("x"), F.max("h").alias("y")).where("c > 1")
                        .select("a", (F.col("x") != F.col("y")).alias("differ")), "sub-anchors")
    shared = materialize(found.join(often, "a"), "sub-shared")
    spans = materialize(shared.groupBy("a", "h").count().where("count > 1").select("a", "h", F.lit(True).alias("equal")), "sub-spans")
    marked = materialize(shared.join(spans, ["a", "h"], "left").select(*_TEXT, "s", "m", "a", "h", "differ", F.col("equal").isNotNull().alias("equal")), "sub-marked")
    discard(often, shared, spans)

    full = marked.where("equal").select(*_TEXT, F.col("s").alias("from"), (F.col("s") + F.col("m") + window - 1).alias("to"))
    own = marked.where("differ and not equal").select(*_TEXT, "s", "m", "a", F.lit(True).alias("target"))
    witness = (marked.where("differ and equal").groupBy("a", "h").agg(F.min(F.struct(*_TEXT, "s", "m")).alias("w"))
               .select("w.doc", "w.d1", "w.s", "w.m", "a", F.lit(False).alias("target")))
    extended = materialize(_windows(texts, own.unionByName(witness), window), "sub-windows")
    again = materialize(extended.groupBy("a", "w").count().where("count > 1").select("a", "w"), "sub-again")
    single = (extended.where("target").join(again, ["a", "w"])
              .select(*_TEXT, F.col("s").alias("from"), (F.col("s") + window).alias("to")))
    ranges = whole.unionByName(full).unionByName(single)
    out = materialize(ranges.groupBy(*_TEXT).agg(F.collect_set(F.struct("from", "to")).alias("spans")), "sub-ranges")
    discard(scanned, classes, marked, extended, again)
    return out


def kept_digest(chunk: Chunk, words: Words, row: int, at: np.ndarray, whole: bool) -> str:
    """SHA-256 of the kept words, joined by one space."""
    if whole:
        kept = b" ".join(chunk.text(chunk.offsets[row], chunk.offsets[row + 1]).split())
    else:
        kept = b" ".join(chunk.text(a, b) for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True))
    return hashlib.sha256(kept).hexdigest()


def kept_text(chunk: Chunk, words: Words, row: int, at: np.ndarray, whole: bool) -> str:
    """The text without the cut words: as it was if none is cut, else its kept stretches joined by one space."""
    if whole:
        return chunk.text(chunk.offsets[row], chunk.offsets[row + 1]).decode()
    if not len(at):
        return ""
    cut = np.flatnonzero(np.diff(at) > 1) + 1
    first, last = at[np.append(0, cut)], at[np.append(cut - 1, len(at) - 1)]
    return b" ".join(chunk.text(a, b) for a, b in zip(words.starts[first].tolist(), words.ends[last].tolist(), strict=True)).decode()


def cut(docs: DataFrame, kept: Callable, name: str, window: int = WINDOW, key: str = "doc_id", text: str = "text",
        keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep``), ``n_words``, ``n_removed`` and ``name``, which is what ``kept`` makes of the kept words."""
    arrow_batches(docs.sparkSession)
    keep = [key] if keep is None else keep
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"),
                        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    found = repeats(texts, window)
    wanted = id_filter(found.select("doc"))
    maybe = _picked(texts, wanted, ["doc", "text", "row"]).join(found, _TEXT, "left").select("doc", "text", "row", "spans")
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def done(batch: pa.RecordBatch, spans: Callable[[int], list | None]) -> pa.RecordBatch:
        totals, removed, made = [], [], []
        for chunk in chunks(batch.column(1)):
            words = split_words(chunk)
            for r, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True)):
                covered = np.zeros(b - a + 1, np.int64)
                for span in spans(chunk.lo + r) or ():
                    covered[span["from"]] += 1
                    covered[span["to"]] -= 1
                at = a + np.flatnonzero(np.cumsum(covered)[:-1] == 0)
                totals.append(b - a)
                removed.append(b - a - len(at))
                made.append(kept(chunk, words, r, at, removed[-1] == 0))
        return pa.RecordBatch.from_arrays([batch.column(2), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(made, pa.string())],
                                          ["row", "n_words", "n_removed", name])

    def with_repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield done(batch, lambda r, column=batch.column(3): column[r].as_py())

    def without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield done(batch.filter(pa.array(~shared.value[id_slot(batch.column(0).to_numpy())])), lambda r: None)

    schema = T.StructType([texts.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField(name, T.StringType())])
    return maybe.mapInArrow(with_repeats, schema).unionByName(texts.select("doc", "text", "row").mapInArrow(without, schema))


def cut_sql(window: int) -> str:
    """The removed words as DuckDB SQL, by counting all windows; ``kept_sha256`` as the query has it."""
    return rf"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + {window - 1}], ' ') AS c
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 1} + 1)) AS i FROM words WHERE len(w) >= {window})),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY c) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {window})) AS i FROM again),
each AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM words),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
