"""Toxic passages by maximum-scoring segments over token log-odds.

* Token weights: log-odds of a token in toxic against other labelled documents, with an
  informative Dirichlet prior whose shape is the token's share in the whole corpus (all documents,
  labelled or not).  A weight is shrunk by its standard error, so rare tokens weigh nothing.
  A small cost per token makes ordinary text score below zero.
* Passages: all maximal scoring segments of a document, by a linear scan with a stack
  (Ruzzo and Tompa).  Only tokens of positive weight need a step; the cost between them is a difference of sums.
* Calibration: by extreme-value theory the best segment of ordinary text of n tokens exceeds S with
  probability about n exp(-lambda S).  lambda solves ``sum p exp(lambda s) = 1`` over the tokens of documents
  that aren't toxic.  The excesses of ``lambda S`` over ``log n`` of all significant passages add up to the document's evidence, and a
  logistic curve, fitted to documents scored by weights from the other half, turns it into a probability.

Tokens are runs of letters, digits and non-ASCII bytes, lower-cased; a token weighs as much as the heaviest
of itself and its stems.  Labels are used up to about ``MAX_LABELS`` rows, chosen by a hash of the id, and
joined by broadcast, so no text is shuffled.  The vocabulary is the tokens (64-bit hashes) of at least ``LEAST_DOCS`` of these
labelled documents, counted in a Spark table; it grows with the labelled sample only, so it may be collected and broadcast.
All other tokens are one, which weighs no more than the cost: a token that one labelled document or none holds would be shrunk to that anyway.
Each token of the vocabulary has a counter of its own, and counting covers all documents.

Defined results: a null or empty text has no passage and gets the probability of no evidence; labels with
null are ignored, equal labels count once, and a document with several labels is toxic if one is; without both
classes among the labels every score is the smoothed share of toxic labels; rows with the same id
are scored each by its text; a very long text is scored whole; an empty table gives an empty result; other columns are ignored by ``score`` and kept by ``reject``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.common import arrow_batches, counter_rows, materialize, sum_counters
from tagpulse.llm.words import NOT_ALNUM, chunks, prefix_hashes, split_words

#: Labelled documents that must hold a token to give it a weight.
LEAST_DOCS = 2
#: Lengths in bytes of the stems that stand in for inflected forms seen too rarely.
STEMS = (4, 5, 6)
MAX_LABELS = 200_000
#: Strength of the prior, in shares of the labelled tokens, and how many standard errors a weight loses.
PRIOR_SHARE = 0.2
SHRINK = 1.5
TOKEN_COST = 0.05
BINS, BIN_WIDTH, LEAST = 4096, 0.05, -10.0


def fold(key: Column) -> Column:
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 5


class Vocabulary:
    """Places of hashes in a sorted table; what isn't there has the place behind its end."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(hashes)
        bits = len(self.hashes).bit_length() + 2
        self.shift = np.uint64(64 - bits)
        starts = np.searchsorted(self.hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift)
        self.starts = starts.astype(np.int32)
        self.probes = int(np.diff(starts, append=len(self.hashes)).max())

    def __len__(self) -> int:
        return len(self.hashes)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(hashes.shape, len(self), np.int64)
        first = self.starts[hashes >> self.shift]
        for probe in range(self.probes):
            at = np.minimum(first + probe, len(self) - 1)
            hit = self.hashes[at] == hashes
            out[hit] = at[hit]
        return out


@dataclass(frozen=True)
class Model:
    vocabulary: Vocabulary
    weights: np.ndarray
    rate: float
    intercept: float
    slope: float


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, in order of position."""
    sums = np.concatenate([[0.0], np.cumsum(scores, dtype=np.float64)])
    at = np.flatnonzero(scores > 0)
    stack: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    for i, left, right in zip(at.tolist(), sums[at].tolist(), sums[at + 1].tolist(), strict=True):
        start, end = i, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= left:
                j -= 1
            if j < 0 or stack[j][3] >= right:
                break
            start, left = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((start, end, left, right))
    return [(a, b, r - lo) for a, b, lo, r in stack]


def _tokens(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, hashes by level and token, first token of each row)`` of each chunk."""
    for chunk in chunks(column):
        words = split_words(chunk, lower=True, separators=NOT_ALNUM)
        hashes = [words.hashes, *[prefix_hashes(chunk, words, n, lower=True) for n in STEMS]]
        yield chunk.lo, chunk.hi, np.stack(hashes), words.first


def _vocabulary(rows: DataFrame) -> Vocabulary:
    """The tokens that at least ``LEAST_DOCS`` of the labelled documents ``text`` hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, token, first in _tokens(batch.column(0)):
                found, place = np.unique(token, return_inverse=True)
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                pair = np.unique(row * max(1, len(found)) + place.reshape(token.shape))  # once a document
                docs = np.bincount(pair % max(1, len(found)), minlength=len(found))
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(docs, pa.int64())], ["token", "docs"])

    counted = rows.mapInArrow(run, "token long, docs long").groupBy("token").agg(F.sum("docs").alias("docs"))
    table = materialize(counted.where(F.col("docs") >= LEAST_DOCS).select("token"), "toxicity-vocabulary").toArrow()
    return Vocabulary(table.column("token").to_numpy().view(np.uint64))


def token_scores(weights: np.ndarray, token: np.ndarray) -> np.ndarray:
    """The weight of each token: the largest among its own and its stems'."""
    return weights[token].max(axis=0)


def _count(rows: DataFrame, vocabulary: Vocabulary) -> np.ndarray:
    """Documents that hold each token, the last one being all others: all, and by half and label ``1 + 2 * half + label``."""
    size, shared = len(vocabulary) + 1, rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((5, size), np.int64)
        for batch in batches:
            groups = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, hashes, first in _tokens(batch.column(0)):
                token = shared.value.places(hashes)
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                pair = np.unique(row * size + token)  # once a document, however often it has the token
                token, group = pair % size, groups[lo:hi][pair // size]
                np.add.at(counts[0], token, 1)
                np.add.at(counts.reshape(-1), (group * size + token)[group > 0], 1)
        blocks = list(counter_rows(counts))
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())],
                                             ["block", "counts"])

    return sum_counters(rows.mapInArrow(run, "block int, counts binary"), (5, size))


def log_odds(corpus: np.ndarray, toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Token weights: log-odds with a Dirichlet prior, shrunk by their standard error, less the token cost.

    The last token stands for all others and weighs the cost."""
    shape = (corpus + 1e-3) / (corpus + 1e-3).sum()
    prior = PRIOR_SHARE * (toxic.sum() + other.sum() + 1) * shape
    a, b = toxic + prior, other + prior
    with np.errstate(divide="ignore", invalid="ignore"):  # without a vocabulary there is no gap, and the last token takes none
        gap = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    error = np.sqrt(1 / a + 1 / b)
    kept = np.sign(gap) * np.maximum(np.abs(gap) - SHRINK * error, 0)
    kept[-1] = 0
    return (kept - TOKEN_COST).astype(np.float32)


def extreme_rate(weights: np.ndarray, share: np.ndarray) -> float:
    """The positive root of ``sum share * exp(rate * weight) = 1``."""
    if not share.sum() or weights[share > 0].max() <= 0:
        return 1.0
    share, low, high = share / share.sum(), 0.0, 1.0

    def grows(x: float) -> bool:
        return float((share * np.exp(np.minimum(x * weights.astype(np.float64), 700))).sum()) > 1

    while not grows(high) and high < 1e3:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (low, middle) if grows(middle) else (middle, high)
    return max(high, 1e-3)


def _evidence(scores: np.ndarray, rate: float) -> tuple[float, int, float]:
    """Sum of significant excesses (or the best one that isn't, at least ``LEAST``), their number, best raw score."""
    found = [s for _, _, s in segments(scores)]
    if not found:
        return LEAST, 0, 0.0
    excess = rate * np.array(found) - np.log(len(scores))
    above = excess[excess > 0]
    return float(above.sum()) if len(above) else max(float(excess.max()), LEAST), len(above), max(found)


def _fit(histogram: np.ndarray) -> tuple[float, float]:
    """Logistic curve of ``label ~ evidence`` over binned counts ``(2, bins)``, by Newton's method with a weak ridge."""
    x = (np.arange(histogram.shape[1]) + 0.5) * BIN_WIDTH + LEAST
    n = histogram.sum(axis=0)
    total = max(int(n.sum()), 1)
    share = (histogram[1].sum() + 1) / (total + 2)
    beta = np.array([np.log(share / (1 - share)), 0.0])
    if not histogram[0].sum() or not histogram[1].sum():
        return float(beta[0]), 0.0
    z = np.stack([np.ones_like(x), x])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(beta @ z, -30, 30)))
        slope = z @ (histogram[1] - n * p) - 1e-3 * beta
        curve = (z * (n * p * (1 - p))) @ z.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(max(beta[1], 0.0))


def _calibration(rows: DataFrame, vocabulary: Vocabulary, models: list[tuple[np.ndarray, float]]) -> np.ndarray:
    """Histogram ``(2, BINS)`` of evidence by label; each labelled document is scored by the other half's weights."""
    shared = rows.sparkSession.sparkContext.broadcast((vocabulary, models))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (vocabulary, models), counts = shared.value, np.zeros((2, BINS), np.int64)
        for batch in batches:
            groups = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, _, hashes, first in _tokens(batch.column(0)):
                token = vocabulary.places(hashes)
                scores = [token_scores(models[1 - half][0], token) for half in (0, 1)]
                for r, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                    half, label = divmod(int(groups[lo + r]) - 1, 2)
                    value = _evidence(scores[half][a:b], models[1 - half][1])[0]
                    counts[label, min(int((value - LEAST) / BIN_WIDTH), BINS - 1)] += 1
        blocks = list(counter_rows(counts))
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())],
                                             ["block", "counts"])

    return sum_counters(rows.mapInArrow(run, "block int, counts binary"), (2, BINS))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_labels: int = MAX_LABELS) -> Model:
    """Fit weights and calibration to ``labels`` ``(doc_id, toxic)`` and the whole corpus."""
    arrow_batches(docs.sparkSession)
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = materialize(marked.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")), "labels")
    known = marked.count()
    kept = marked if known <= max_labels else marked.where(
        F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int((1 << 30) * max_labels / known))
    group = (1 + 2 * F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)) + F.col("toxic")).cast("int")
    kept = F.broadcast(kept.select("doc_id", group.alias("label_group")))
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    labelled = rows.join(kept, "doc_id").select("text", "label_group")
    vocabulary = _vocabulary(labelled.select("text"))
    every = rows.join(kept, "doc_id", "left").select("text", F.coalesce("label_group", F.lit(0)).alias("label_group"))
    counts = _count(every, vocabulary).astype(np.float64)
    corpus, groups = counts[0], counts[1:].reshape(2, 2, -1)  # half, label, token

    def weigh(part: np.ndarray) -> tuple[np.ndarray, float]:
        weights = log_odds(corpus, part[1], part[0])
        return weights, extreme_rate(weights, part[0] + 0.02)

    histogram = _calibration(labelled, vocabulary, [weigh(groups[0]), weigh(groups[1])])
    intercept, slope = _fit(histogram)
    weights, rate = weigh(groups.sum(axis=0))
    return Model(vocabulary, weights, rate, intercept, slope)


def _judged(hashes: np.ndarray, first: np.ndarray, m: Model) -> tuple[np.ndarray, list[tuple[float, int, float]]]:
    scores = token_scores(m.weights, m.vocabulary.places(hashes))
    found = [_evidence(scores[a:b], m.rate) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]
    evidence = np.array([f[0] for f in found])
    return 1 / (1 + np.exp(-np.clip(m.intercept + m.slope * evidence, -700, 700))), found


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, n_passages, best_passage, evidence`` of every row."""
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, hashes, first in _tokens(batch.column(1)):
                chance, found = _judged(hashes, first, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(chance), pa.array([f[1] for f in found], pa.int32()),
                     pa.array([f[2] for f in found], pa.float64()), pa.array([f[0] for f in found], pa.float64())],
                    ["doc_id", "score", "n_passages", "best_passage", "evidence"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, n_passages int, best_passage double, evidence double")


def reject(docs: DataFrame, model: Model, limit: float = 0.5, text: str = "text") -> DataFrame:
    """The rows whose score is below ``limit``, with the columns they had."""
    arrow_batches(docs.sparkSession)
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, hashes, first in _tokens(batch.column(at)):
                yield batch.slice(lo, hi - lo).filter(pa.array(_judged(hashes, first, shared.value)[0] < limit))

    return docs.mapInArrow(run, docs.schema)
