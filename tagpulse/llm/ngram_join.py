"""Similarity join of documents on word n-grams: all links of a Jaccard threshold, and their components.

A document's set holds its distinct n-word shingles (64-bit hashes); shorter documents have their whole word
sequence as one.  Steps:

1. One scan gives each set's size and 128-bit digest, and counts shingles into ``2**SKETCH_BITS`` counters (a
   fixed size).  The order "rare first" is by counter, then by hash.  Counters reach the tasks as logarithms of one byte, an
   eighth of a doubling each, so they rank at any size.  Any order gives right links; a good one gives short lists.
2. Of each set only the prefix matters: as many of its rarest shingles as a set alike must share one of.
   Of equal sets a task keeps one.  Prefixes are stored in packed chunks.  A chunk asks by bucket of the hash which of its
   shingles more than one set has in its prefix; only those are posted as rows, so that the many shingles that nobody
   shares never are.  Of shingles posted by the same sets all but the first go.
3. Candidates share a posted shingle and pass the length and positional filters.  First, every posting is paired
   only with the hub of its list (the posting nearest to the head of its set).  The links found join documents into
   components; then the pairs of each list that are still in different components are joined, all of them.
   So a large group of near copies costs about a pair for each member and list, and no link that could change a
   component is left out.
4. Each pair is verified once, from its texts: a suffix filter bounds the overlap by binary partition, and the
   exact intersection decides.
5. Components are labels by the smallest id reachable over links and equal sets.

Sets, postings, pairs and labels are tables; what the driver holds has a fixed size (counters).  Joins are
plain shuffles that split on a hot key, counts are pre-aggregated.

Defined results: a null text, or one without words, has the empty set and links with nothing; a null id keeps its row, with a
null component, and links with nothing; rows with the same id are one node, each row with its own size; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.common import arrow_batches, components, counter_rows, discard, id_filter, id_slot, look_up, materialize, sum_counters
from tagpulse.llm.tokens import bucket_cuts, pack, pack_sorted, unpack, unpack_sorted
from tagpulse.llm.words import chunks, mix, signed, split_words, span_hashes, window_hashes
from tagpulse.session import delete_path, scratch_path

SKETCH_BITS = 24
#: Steps of a counter's logarithm in a doubling; a byte then ranks counts up to 2**31.
RANK_STEPS = 8
#: Shingles in a chunk of prefixes, and for each bucket of requests.
CHUNK_TOKENS, BUCKET_TOKENS = 1 << 18, 1 << 20
_U = np.uint64


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every row, in order."""
    for chunk in chunks(column):
        words = split_words(chunk, lower=True)
        grams = window_hashes(words.hashes, n)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(grams[a:b - n + 1])
            elif b > a:
                yield span_hashes(words.hashes, np.array([a]), np.array([b]))
            else:
                yield np.empty(0, _U)


def _digest(s: np.ndarray) -> tuple[int, int]:
    a = mix(s ^ _U(0x5851F42D4C957F2D))
    return int(a.sum(dtype=_U).view(np.int64)), int(mix(a).sum(dtype=_U).view(np.int64))


_SCAN = "doc_id bigint, n bigint, d1 bigint, d2 bigint, block int, counts binary, kind int"


def _scan(docs: DataFrame, n: int) -> DataFrame:
    """Sizes and digests of all sets, and the tasks' counters, in one table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SKETCH_BITS, np.uint16)
        names = ["doc_id", "n", "d1", "d2", "block", "counts", "kind"]
        for batch in batches:
            sizes, digests = [], []
            for s in shingle_sets(batch.column(1), n):
                sizes.append(len(s))
                digests.append(_digest(s))
                slot = s >> _U(64 - SKETCH_BITS)
                counts[slot] += counts[slot] < np.iinfo(np.uint16).max
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                 pa.array([d[1] for d in digests], pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                 pa.array(np.zeros(rows, np.int32))], names)
        for block, blob in counter_rows(counts, np.uint16):
            yield pa.RecordBatch.from_arrays(
                [*[pa.nulls(1, pa.int64()) for _ in range(4)], pa.array([block], pa.int32()), pa.array([blob], pa.binary()), pa.array([1], pa.int32())], names)

    return docs.mapInArrow(run, _SCAN)


def prefix_length(n: int, percent: int) -> int:
    return n + (-n * percent // 100) + 1


_PREFIXES = "chunk bigint, doc_ids array<bigint>, sizes array<int>, lengths array<int>, marks array<bigint>, tokens binary"
_POSTED = "token bigint, doc_id bigint, n int, pos int, mark bigint"


def _prefixes(docs: DataFrame, n: int, percent: int, ranks: np.ndarray) -> DataFrame:
    """Every set's prefix, in chunks: ids, set sizes, prefix lengths, digests, and the shingles rarest first.  Equal sets once a task."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary()]

    def chunk(held: list[tuple]) -> pa.RecordBatch:
        ids, sizes, marks, tokens = zip(*held, strict=True)
        row = [int.from_bytes(os.urandom(8), "little") >> 1, list(ids), list(sizes), [len(t) for t in tokens], list(marks), np.concatenate(tokens).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], [c.split()[0] for c in _PREFIXES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen, held, size = shared.value, set(), [], 0
        for batch in batches:
            for doc, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), n), strict=True):
                if doc is None or not len(s) or (digest := _digest(s)) in seen:
                    continue
                seen.add(digest)
                order = np.argsort(rarity[s >> _U(64 - SKETCH_BITS)], kind="stable")
                held.append((doc, len(s), digest[0], s[order[:prefix_length(len(s), percent)]]))
                size += len(held[-1][3])
                if size >= CHUNK_TOKENS:
                    yield chunk(held)
                    held, size = [], 0
        if held:
            yield chunk(held)

    return docs.mapInArrow(run, _PREFIXES)


def _asked(prefixes: DataFrame, buckets: int) -> DataFrame:
    """Each chunk's distinct shingles by bucket, and which of them it has more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, tokens in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found, times = np.unique(np.frombuffer(tokens.as_py(), _U), return_counts=True)
                cuts = bucket_cuts(found, buckets)
                rows = [(b, pack_sorted(found[lo:hi]), pack((times[lo:hi] > 1).astype(_U)))
                        for b, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)) if hi > lo]
                yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(rows), pa.int64()), *[
                    pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)]], ["chunk", "bucket", "tokens", "twice"])

    return prefixes.select("chunk", "tokens").mapInArrow(run, "chunk bigint, bucket int, tokens binary, twice binary")


def _answered(group: pd.DataFrame) -> pd.DataFrame:
    """For each request of a bucket, the shingles that are in more than one prefix."""
    tokens = [unpack_sorted(x) for x in group["tokens"]]
    ends = np.cumsum([len(t) for t in tokens])
    _, which, chunks_ = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    shared = chunks_ > 1
    twice = np.concatenate([unpack(x) for x in group["twice"]]) > 0
    np.logical_or.at(shared, which, twice)
    return pd.DataFrame({"chunk": group["chunk"], "tokens": [
        pack_sorted(t[shared[w]]) for t, w in zip(tokens, np.split(which, ends[:-1]), strict=True)]})


def _postings(prefixes: DataFrame, answers: DataFrame) -> DataFrame:
    """``token, doc_id, n, pos, mark`` of the shingles that more than one prefix has; ``mark`` is a digest of the set."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        wanted = np.sort(np.concatenate([unpack_sorted(x) for x in right["tokens"]])) if len(right) else np.empty(0, _U)
        out = []
        for row in left.itertuples():
            tokens, lengths = np.frombuffer(row.tokens, _U), np.asarray(row.lengths, np.int64)
            spot = np.minimum(np.searchsorted(wanted, tokens), max(0, len(wanted) - 1))
            keep = wanted[spot] == tokens if len(wanted) else np.zeros(len(tokens), bool)
            of = np.repeat(np.arange(len(lengths)), lengths)[keep]
            pos = (np.arange(len(tokens)) - np.repeat(np.cumsum(lengths) - lengths, lengths))[keep]
            out.append(pd.DataFrame({"token": signed(tokens[keep]), "doc_id": np.asarray(row.doc_ids, np.int64)[of], "n": np.asarray(row.sizes, np.int32)[of],
                                     "pos": pos.astype(np.int32), "mark": np.asarray(row.marks, np.int64)[of]}))
        return pd.concat(out) if out else pd.DataFrame({c.split()[0]: [] for c in _POSTED.split(", ")})

    return prefixes.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, _POSTED)


def _filters(percent: int, n_a: Column, pos_a: Column, n_b: Column, pos_b: Column) -> Column:
    """Length filter, and the positional bound on the overlap behind the first common shingle."""
    least = F.ceil((n_a + n_b) * percent / (100 + percent))
    behind = F.least(n_a - pos_a, n_b - pos_b)
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & (behind >= least)


def least_overlap(n_a: int, n_b: int, percent: int) -> int:
    return -(-(n_a + n_b) * percent // (100 + percent))


def suffix_bound(a: np.ndarray, b: np.ndarray, depth: int = 2) -> int:
    """A lower bound of the number of elements that only one of two sorted sets has, by halving ``b``."""
    if not depth or not len(a) or not len(b):
        return abs(len(a) - len(b))
    middle = len(b) // 2
    at = int(np.searchsorted(a, b[middle]))
    same = at < len(a) and a[at] == b[middle]
    return (suffix_bound(a[:at], b[:middle], depth - 1) + suffix_bound(a[at + same:], b[middle + 1:], depth - 1) + (not same))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    need = least_overlap(len(a), len(b), percent)
    if suffix_bound(a, b) > len(a) + len(b) - 2 * need:
        return False
    return len(np.intersect1d(a, b, assume_unique=True)) >= need


def _verified(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold.

    The texts of those documents that may be in a pair go to the sides they are needed on: compressed, a text is half
    the size of its set, and making the set again is cheap."""
    shared = docs.sparkSession.sparkContext.broadcast([id_filter(pairs.select(side)) for side in ("a", "b")])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = id_slot(batch.column(0).to_numpy())
            first, second = (wanted[slot] for wanted in shared.value)
            either = first | second
            kept = batch.filter(pa.array(either))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(first[either]), pa.array(second[either])], ["doc_id", "text", "first", "second"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [alike(x, y, percent) for x, y in zip(shingle_sets(batch.column(2), n), shingle_sets(batch.column(3), n), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    found = docs.where("doc_id is not null").mapInArrow(pick, "doc_id bigint, text string, first boolean, second boolean")
    texts = materialize(found, "join-texts")
    # Pairs and texts both grow with the documents: the same shuffle join at every size.
    one = pairs.hint("merge").join(texts.where("second").select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
    two = one.hint("merge").join(texts.where("first").select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
    links = materialize(two.select("a", "b", "x", "y").mapInArrow(verify, "a bigint, b bigint").distinct(), "join-links")
    discard(texts)
    return links


def linked(docs: DataFrame, n: int, percent: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    arrow_batches(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    scan_path = scratch_path(docs.sparkSession, "join-scan")
    _scan(docs, n).write.partitionBy("kind").parquet(scan_path)
    scanned = docs.sparkSession.read.schema(_SCAN).parquet(scan_path)
    rows = scanned.where("kind = 0").select("doc_id", "n", "d1", "d2")
    ranks = sum_counters(scanned.where("kind = 1").select("block", "counts"), (1 << SKETCH_BITS,), np.uint16, np.uint32,
                         lambda part: np.minimum(255, np.rint(RANK_STEPS * np.log2(1.0 + part))).astype(np.uint8))
    delete_path(docs.sparkSession, f"{scan_path}/kind=1")

    # Equal sets: everyone links with the smallest id.
    known = rows.where("n > 0 and doc_id is not null")
    classes = materialize(known.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                          .where("copies > 1"), "join-classes")
    copies = look_up(known, classes, ["d1", "d2", "n"], "copies", max(1, known.count())).where("doc_id <> rep").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b"))

    prefixes = materialize(_prefixes(docs, n, percent, ranks), "join-prefixes")
    total = prefixes.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    answers = materialize(_asked(prefixes, max(1, -(-total // BUCKET_TOKENS))).groupBy("bucket").applyInPandas(_answered, "chunk bigint, tokens binary"), "join-answers")
    posted = materialize(_postings(prefixes, answers), "join-postings")
    discard(prefixes, answers)
    # Shingles that the same sets post are in the same order in each; the first finds all that the others could.
    # A set posted by several tasks posts its whole prefix in each, so equal multisets of (id, set) are equal lists.
    # Sums don't cancel; of 32 bits each, they don't overflow.
    first, second = (F.xxhash64("doc_id", "mark", F.lit(seed)) for seed in (1, 2))
    members = [F.sum(F.shiftrightunsigned(first, 32)).alias("m1"), F.sum(first.bitwiseAND(F.lit(0xFFFFFFFF))).alias("m2"),
               F.bit_xor(second).alias("m3")]
    often = posted.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("pos").alias("first"), *members).where("c > 1")
    often = materialize(often.groupBy("c", "m1", "m2", "m3").agg(F.min(F.struct("first", "token")).alias("t")).select("t.token"), "join-tokens")
    lists = materialize(posted.drop("mark").hint("merge").join(often, "token"), "join-lists")
    discard(posted, often)

    hubs = lists.groupBy("token").agg(F.min(F.struct("pos", "doc_id", "n")).alias("hub"))
    hubs = materialize(hubs.select("token", F.col("hub.doc_id").alias("hub"), F.col("hub.pos").alias("hub_pos"), F.col("hub.n").alias("hub_n")), "join-hubs")

    def once(pairs: DataFrame, x: str, y: str) -> DataFrame:
        """Each unordered pair once, as ``(a, b)``; ``a`` is ``x`` in one of its rows."""
        rows = pairs.select(F.least(x, y).alias("low"), F.greatest(x, y).alias("high"), F.col(x).alias("x"))
        return rows.groupBy("low", "high").agg(F.min("x").alias("a")).select(
            "a", F.when(F.col("a") == F.col("low"), F.col("high")).otherwise(F.col("low")).alias("b"), "low", "high")

    star = (lists.join(hubs, "token")
            .where((F.col("doc_id") != F.col("hub")) & _filters(percent, F.col("n"), F.col("pos"), F.col("hub_n"), F.col("hub_pos"))))
    star = materialize(once(star, "hub", "doc_id"), "join-star")
    links = _verified(star.select("a", "b"), docs, n, percent)
    edges = copies.unionByName(links)
    labels = components(edges)

    # What is still apart in a list: everyone outside the hub's component against all outside their own.
    label = labels.select(F.col("node").alias("doc_id"), "component")
    labelled = materialize(lists.hint("merge").join(label, "doc_id", "left").select("token", "doc_id", "n", "pos", F.coalesce("component", "doc_id").alias("component")), "join-labelled")
    home = hubs.join(label.withColumnRenamed("doc_id", "hub"), "hub", "left").select("token", F.coalesce("component", "hub").alias("home"))
    mixed = labelled.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    open_lists = materialize(mixed.join(home, "token"), "join-open")
    members = materialize(labelled.join(open_lists, "token"), "join-members")
    outside = members.where("component <> home").select(
        "token", F.col("doc_id").alias("p"), F.col("n").alias("n_p"), F.col("pos").alias("pos_p"), F.col("component").alias("c_p"))
    apart = (F.col("component") != F.col("c_p")) & ((F.col("component") == F.col("home")) | (F.col("p") < F.col("doc_id")))
    rest = outside.join(members, "token").where(apart & _filters(percent, F.col("n_p"), F.col("pos_p"), F.col("n"), F.col("pos")))
    rest = materialize(once(rest, "p", "doc_id").join(star, ["low", "high"], "left_anti").select("a", "b"), "join-rest")
    more = _verified(rest, docs, n, percent)
    if not more.isEmpty():
        labels = components(edges.unionByName(more))
    discard(lists, hubs, labelled, open_lists, members, star, rest)
    named = labels.select(F.col("node").alias("doc_id"), "component")
    return rows.join(named, "doc_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def linked_sql(n: int, percent: int) -> str:
    """The same result as DuckDB SQL, by comparing all pairs that share a shingle."""
    return rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + {n - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {n - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= {percent} * (p.n + q.n - common)),
reach(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.doc_id)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id
"""
