"""Language-model scores by deleted interpolation of unigram and bigram estimates.

``P(w | v) = l2(b) c(v, w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1)``: maximum-likelihood estimates of the training
documents, mixed by weights that depend on the bucket ``b`` of the context's frequency (its power of two; bucket 0: a context
that was never seen, which has no bigram term).  Words outside the training vocabulary are one word, so the model sums to one.  A
document ends with an end token, which is also the context of the first word.

The weights are learned by expectation-maximisation on held-out counts: every document of the deleted part (a
tenth of the training documents, by checksum of the id) is scored by the counts of all training documents but itself.

How it runs:

1. One scan cuts the documents into chunks of about ``CHUNK`` bytes, whose words become numbers: a *sheet*.  Sheets are stored.  A
   sheet's distinct words and bigrams, with their counts among training documents, go as packed requests to buckets by hash.
2. A bucket's task adds up the counts of all chunks and answers each request in its order.  A gram is once in a chunk's request, so
   no gram, however frequent, makes a bucket large; the number of buckets follows the bytes of text.
3. Sheets and answers of a chunk meet: those of the deleted part give likelihood ratios on a grid of fixed steps, on which
   each frequency bucket's weights are found; then every chunk's documents are scored.

Counts cover all documents and are exact up to equal 64-bit hashes.  Only the weights (a row for each power of two) and two
totals reach the driver.

Defined results: a null or empty text is one end token; a null id counts as the empty text in checksums and
keeps its row; rows with the same id are scored each by its text; with no training document every word is unknown; an
empty table gives an empty result; a text of any length is scored whole (a chunk of its own); other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.common import materialize
from tagpulse.llm.tokens import LOWER, batch_bytes, batch_rows, bucket_cuts, gathered, pack, pack_sorted, runs, text_bytes, unpack, unpack_sorted
from tagpulse.llm.words import IS_SPACE, mix, run_hashes
from tagpulse.session import ship_package

#: Bytes of text in a chunk, and for each bucket of grams.
CHUNK, BUCKET_BYTES = 8 << 20, 16 << 20
#: Steps of the grid of likelihood ratios in a factor of two.
STEPS = 8
#: One in so many training documents is deleted in turn to learn the weights.
DELETED = 10
EM_ROUNDS, EM_CLOSE = 200, 1e-7
WORDS, PAIRS = 1, 2
_U = np.uint64
#: The end token's hash.
END = _U(0x5851F42D4C957F2D)

_SHEETS = "chunk bigint, part int, doc_ids array<bigint>, held array<boolean>, lengths array<bigint>, words binary, tokens binary"
_REQUESTS = "chunk bigint, part int, kind int, bucket int, hashes binary, counts binary"
_ANSWERS = "chunk bigint, part int, kind int, bucket int, counts binary, v bigint, n bigint"
_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def checksum(key: Column) -> Column:
    """crc32 of the id as text (null: of the empty text)."""
    return F.crc32(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8"))


def held_out_fold(key: Column) -> Column:
    return checksum(key) % 7 == 2


def deleted_part(key: Column) -> Column:
    """One in ``DELETED`` of the other documents, by the same checksum."""
    return F.floor(checksum(key) / 7) % DELETED == 0


def stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of all rows, each row followed by the end token, and the rows' lengths."""
    data, rows = text_bytes(column)
    data = LOWER[data]
    starts, ends, first = runs(~IS_SPACE[data], rows)
    out = np.full(len(starts) + len(rows) - 1, END, _U)
    counts = np.diff(first)
    out[np.arange(len(starts)) + np.repeat(np.arange(len(counts)), counts)] = run_hashes(data, starts, ends)
    return out, counts + 1


def contexts(words: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The token before each; the end token comes before the first."""
    return np.concatenate([[int(np.searchsorted(words, END))], tokens[:-1]])


def pair_hashes(words: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The hash of each token with its context."""
    return mix(mix(words + _U(0xD1342543DE82EF95))[contexts(words, tokens)] ^ words[tokens])


def sheets(docs: DataFrame) -> DataFrame:
    """Chunks of ``doc_id, text, held, deleted`` rows as sheets; documents of the deleted part (1) are chunks of their own."""
    schema = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
                        ("lengths", pa.list_(pa.int64())), ("words", pa.binary()), ("tokens", pa.binary())])

    def sheet(part: int, batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, lengths = stream(batch.column(1))
        words, tokens = np.unique(hashes, return_inverse=True)
        row = [int.from_bytes(os.urandom(8), "little") >> 1, part, batch.column(0).to_pylist(), batch.column(2).to_pylist(), lengths.tolist(), pack_sorted(words), pack(tokens)]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: tuple[list, list] = ([], [])
        held = [0, 0]
        for batch in batches:
            for part, rows in ((0, pc.invert(batch.column(3))), (1, batch.column(3))):
                waiting[part].append(batch.filter(rows))
                held[part] += waiting[part][-1].column(1).nbytes
                if held[part] >= CHUNK:
                    yield from (sheet(part, b) for b in gathered(iter(waiting[part]), CHUNK, 1))
                    waiting[part].clear()
                    held[part] = 0
        for part in (0, 1):
            yield from (sheet(part, b) for b in gathered(iter(waiting[part]), CHUNK, 1))

    return docs.mapInArrow(run, _SHEETS)


def requests(rows: DataFrame, buckets: int) -> DataFrame:
    """Each sheet's distinct words and pairs by bucket, with their counts among its training documents."""
    names = ["chunk", "part", "kind", "bucket", "hashes", "counts"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def of_sheet(chunk: int, part: int, held: list[bool], lengths: list[int], words: bytes, tokens: bytes) -> Iterator[tuple]:
        words, tokens = unpack_sorted(words), unpack(tokens).astype(np.int64)
        train = np.repeat(~np.array(held, bool), lengths)
        pairs, which = np.unique(pair_hashes(words, tokens), return_inverse=True)
        for kind, grams, at in ((WORDS, words, tokens), (PAIRS, pairs, which)):
            counts = np.bincount(at[train], minlength=len(grams))
            cuts = bucket_cuts(grams, buckets)
            for b, (lo, hi) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                if hi > lo:
                    yield chunk, part, kind, b, pack_sorted(grams[lo:hi]), pack(counts[lo:hi])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                out = list(of_sheet(*(c[i].as_py() for c in batch.columns)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return rows.select("chunk", "part", "held", "lengths", "words", "tokens").mapInArrow(run, _REQUESTS)


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """The counts over all chunks for each request of one bucket, and the bucket's totals."""
    hashes = [unpack_sorted(x) for x in group["hashes"]]
    ends = np.cumsum([len(h) for h in hashes])
    grams, which = np.unique(np.concatenate(hashes), return_inverse=True)
    del hashes
    total = np.zeros(len(grams), np.int64)
    for hi, blob in zip(ends.tolist(), group["counts"], strict=True):
        counts = unpack(blob).astype(np.int64)
        total[which[hi - len(counts):hi]] += counts
    out = pd.DataFrame({"chunk": group["chunk"].astype("Int64"), "part": group["part"].astype("Int64"), "kind": group["kind"].astype("Int64"),
                        "bucket": group["bucket"].astype("Int64"),
                        "counts": [pack(total[w]) for w in np.split(which, ends[:-1])], "v": pd.NA, "n": pd.NA})
    if group["kind"].iat[0] == WORDS:
        out.loc[len(out)] = [pd.NA, pd.NA, WORDS, group["bucket"].iat[0], None, int((total > 0).sum()), int(total.sum())]
    return out.astype({"v": "Int64", "n": "Int64"})


@dataclass(frozen=True)
class Totals:
    """Tokens and distinct tokens of the training documents."""

    n: int
    v: int


def bucket_of(count: np.ndarray) -> np.ndarray:
    """0 for none, else one more than the count's power of two."""
    return np.frexp(count.astype(np.float64))[1]


@dataclass
class Counted:
    """A chunk's tokens with their counts over all training documents."""

    sheet: pd.Series
    lengths: np.ndarray
    tokens: np.ndarray
    pairs: np.ndarray
    context: np.ndarray
    of_token: np.ndarray
    of_context: np.ndarray
    of_pair: np.ndarray


def counted(sheet: pd.Series, answers: pd.DataFrame) -> Counted:
    words, tokens = unpack_sorted(sheet["words"]), unpack(sheet["tokens"]).astype(np.int64)
    counts = {}
    for kind, rows in answers.sort_values("bucket").groupby("kind"):
        counts[kind] = np.concatenate([unpack(x) for x in rows["counts"]]).astype(np.int64)
    _, pairs = np.unique(pair_hashes(words, tokens), return_inverse=True)
    context = contexts(words, tokens)
    return Counted(sheet, np.asarray(sheet["lengths"], np.int64), tokens, pairs, context, counts[WORDS][tokens], counts[WORDS][context], counts[PAIRS][pairs])


def _own(rows: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """How often each token's gram is in the token's own document."""
    _, which, counts = np.unique(rows * (int(grams.max()) + 1) + grams, return_inverse=True, return_counts=True)
    return counts[which]


def _grid(ratio: np.ndarray) -> np.ndarray:
    """The step of a likelihood ratio; null ratios have a step of their own."""
    out = np.full(len(ratio), np.iinfo(np.int32).min, np.int64)
    some = ratio > 0
    out[some] = np.rint(np.log2(ratio[some]) * STEPS)
    return out


def deleted_ratios(c: Counted, totals: Totals) -> pd.DataFrame:
    """``b, q2, q1, n``: how many tokens of deleted documents have these likelihood ratios to the uniform term."""
    rows = np.repeat(np.arange(len(c.lengths)), c.lengths)
    seen = c.of_context - _own(rows, c.context)
    both = c.of_pair - _own(rows, c.pairs)
    alone = c.of_token - _own(rows, c.tokens)
    left = totals.n - np.repeat(c.lengths, c.lengths)
    r2 = both / np.maximum(seen, 1) * (totals.v + 1)
    r1 = alone / np.maximum(left, 1) * (totals.v + 1)
    return pd.DataFrame({"b": bucket_of(seen), "q2": _grid(r2), "q1": _grid(r1)}).value_counts().reset_index(name="n")


def fit(ratios: pd.DataFrame) -> pd.DataFrame:
    """The weights of one frequency bucket, by expectation-maximisation over its grid."""
    b = int(ratios["b"].iat[0])
    none = np.iinfo(np.int32).min
    of = lambda q: np.where(q == none, 0.0, 2.0 ** (np.where(q == none, 0, q) / STEPS))
    ratios = ratios.sort_values(["q2", "q1"])
    likely = np.stack([of(ratios["q2"].to_numpy()), of(ratios["q1"].to_numpy()), np.ones(len(ratios))])
    n = ratios["n"].to_numpy(np.float64)
    weights = np.array([1 / 3] * 3 if b else [0, 0.5, 0.5])
    for _ in range(EM_ROUNDS):
        share = weights[:, None] * likely
        # One token more for each term: none vanishes.
        expected = (share / share.sum(0) * n).sum(1) + (weights > 0)
        new = expected / expected.sum()
        close = np.abs(new - weights).max() < EM_CLOSE
        weights = new
        if close:
            break
    return pd.DataFrame({"b": [b], "l2": [weights[0]], "l1": [weights[1]], "l0": [weights[2]]})


def weights_table(found: list[tuple[int, float, float, float]]) -> np.ndarray:
    """Weights by bucket; a bucket without any takes those of the nearest below, bucket 1 those of the nearest above."""
    out = np.zeros((65, 3))
    known = {b: w for b, *w in found}
    out[0] = known.get(0, [0, 0.5, 0.5])
    above = sorted(b for b in known if b)
    for b in range(1, 65):
        below = [x for x in above if x <= b]
        out[b] = known[below[-1]] if below else known[above[0]] if above else [1 / 3] * 3
    return out


def scored(c: Counted, totals: Totals, weights: np.ndarray) -> pd.DataFrame:
    """The scores of a chunk's documents."""
    starts = np.cumsum(c.lengths) - c.lengths
    mixed = weights[bucket_of(c.of_context)]
    p = (mixed[:, 0] * (c.of_pair / np.maximum(c.of_context, 1)) + mixed[:, 1] * (c.of_token / max(totals.n, 1)) + mixed[:, 2] / (totals.v + 1))
    base = np.log10((c.of_token + 1) / (totals.n + totals.v + 1))
    return pd.DataFrame({
        "doc_id": pd.array(c.sheet["doc_ids"], "Int64"), "held_out": np.asarray(c.sheet["held"], bool), "n_tokens": c.lengths,
        "n_known": np.add.reduceat((c.of_token > 0).astype(np.int64), starts), "base_score": np.add.reduceat(base, starts),
        "score": np.add.reduceat(np.log10(p), starts)})


@dataclass(frozen=True)
class Gathered:
    """Sheets and answered counts, and the training documents' totals."""

    sheets: DataFrame
    answers: DataFrame
    totals: Totals

    def chunks(self, made, schema: str, part: int | None = None) -> DataFrame:  # noqa: ANN001
        """``made`` of every chunk (of one part)."""
        sheets, answers = self.sheets, self.answers.where("chunk is not null").select("chunk", "part", "kind", "bucket", "counts")
        if part is not None:
            sheets, answers = sheets.where(F.col("part") == part), answers.where(F.col("part") == part)

        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            return pd.concat([made(counted(sheet, right)) for _, sheet in left.iterrows()])

        return sheets.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(run, schema)


def count(docs: DataFrame, held_out: Column, deleted: Column, key: str = "doc_id", text: str = "text") -> Gathered:
    """Count words and bigrams of all documents that aren't held out."""
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held"), (~held_out & deleted).alias("deleted"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    with batch_bytes(spark, CHUNK):
        made = materialize(sheets(docs), "lm-sheets")
    with batch_rows(spark, 1):
        asked = requests(made, max(1, -(-size // BUCKET_BYTES)))
        answers = materialize(asked.groupBy("kind", "bucket").applyInPandas(_answer, _ANSWERS), "lm-answers")
    row = answers.where("chunk is null").agg(F.sum("n"), F.sum("v")).first()
    return Gathered(made, answers, Totals(row[0] or 0, row[1] or 0))


def learn_weights(found: Gathered) -> np.ndarray:
    """The mixture's weights by bucket of the context's frequency."""
    totals = found.totals
    cells = found.chunks(lambda c: deleted_ratios(c, totals), "b int, q2 bigint, q1 bigint, n bigint", part=1)
    cells = cells.groupBy("b", "q2", "q1").agg(F.sum("n").alias("n"))
    fitted = cells.groupBy("b").applyInPandas(fit, "b int, l2 double, l1 double, l0 double")
    return weights_table([tuple(r) for r in fitted.collect()])


def score(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    found = count(docs, held_out_fold(F.col(key)), deleted_part(F.col(key)), key, text)
    totals, weights = found.totals, learn_weights(found)
    rows = found.chunks(lambda c: scored(c, totals, weights), _SCORES)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.n).cast("long").alias("train_tokens"), "base_score", "score")
