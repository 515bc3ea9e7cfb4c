"""Spelling variants: all pairs of words that are one edit apart, by composing acceptors.

The vocabulary is an acceptor, and ``A o E o A`` (``E`` the transducer of exactly one inserted, deleted or replaced code point) accepts
the pairs.  It is enumerated in partitions by initial state.  A pair of words of at most ``L`` code points shares a beginning and an
end of together ``L - 1``, so at least half of them at one side:

* the state that a word reaches by the first ``L div 2`` code points is an initial state; all words through it, less that
  beginning, are the acceptor of the partition;
* a mirrored acceptor starts with the last ``L div 2``; it leaves out the pairs that the first kind has, so each pair is found once.

A word of ``l`` code points belongs to the pairs of ``L = l`` and (as the shorter one) of ``L = l + 1``.  A partition of more than
``LARGEST`` words goes on to later initial states by the same rule for what is left of its words, until no more than two
code points are left.  So a beginning that a third of the vocabulary shares is cut like any other, and a task holds one bounded partition.

In a partition the acceptor is minimised (equal right languages are one state), and composition runs over pairs of its states with
memory: equal states share all their endings at once, and a pair of states without a common ending is visited once.

Counting words pre-aggregates in each chunk; words, postings, pairs and roots are tables, and nothing of them reaches
the driver.  A word's root follows by doubling: each round every word takes its form's form.

Defined results: null and empty texts have no words; a null id counts as the empty text in the checksum; rows with the same
id are counted each by its text; ties go to the first word in code-point order; texts of any length are read whole; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.common import discard, materialize
from tagpulse.llm.tokens import LOWER, gathered, runs, text_bytes
from tagpulse.llm.words import LONG, run_hashes
from tagpulse.session import ship_package

CHUNK = 4 << 20
LEAST_LETTERS, LEAST_TIMES = 5, 3
#: One in so many (document, word) loses a code point.
ONE_IN = 97
#: Words in a partition, beyond which it goes on to later initial states.
LARGEST = 2048

_ASCII = np.zeros(256, bool)
_ASCII[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
#: The UTF-8 lead byte of U+00C0 to U+00FF.
_LEAD = 0xC3


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


_CRC = _crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each ``data[start:end]`` behind a text whose crc32 is ``before``."""
    size, state = ends - starts, ~before
    live, at = np.arange(len(starts)), 0
    while len(live) and at < LONG:
        s = state[live]
        state[live] = _CRC[(s ^ data[starts[live] + at]) & 0xFF] ^ (s >> 8)
        at += 1
        live = live[size[live] > at]
    out = ~state
    for i in live.tolist():
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(before[i]))
    return out


def letter_runs(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ASCII letters and of the code points U+00C0 to U+00FF."""
    lead = data == _LEAD
    inside = _ASCII[data] | lead
    inside[1:] |= lead[:-1]
    return runs(inside, rows)


def spelled(docs: DataFrame) -> DataFrame:
    """``word, n`` of ``doc_id, text`` rows, pre-aggregated in each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, CHUNK, 1):
            data, rows = text_bytes(batch.column(1))
            data = LOWER[data]
            starts, ends, first = letter_runs(data, rows)
            before = np.array([zlib.crc32(f"{'' if d is None else d}:".encode()) for d in batch.column(0).to_pylist()], np.uint32)
            sums = checksums(data, starts, ends, np.repeat(before, np.diff(first)))
            cut = sums % ONE_IN == 0
            leads = np.concatenate([[0], np.cumsum(data == _LEAD)])
            letters = ends - starts - (leads[ends] - leads[starts])
            counts: Counter[str] = Counter()
            for i in np.flatnonzero(cut & (letters > LEAST_LETTERS)).tolist():
                run_ = data[starts[i]:ends[i]].tobytes().decode()
                k = int(sums[i]) % len(run_)
                counts[run_[:k] + run_[k + 1:]] += 1
            whole = np.flatnonzero(~cut & (letters >= LEAST_LETTERS))
            _, sample, n = np.unique(run_hashes(data, starts[whole], ends[whole]), return_index=True, return_counts=True)
            text = data.tobytes()
            a, b = starts[whole][sample].tolist(), ends[whole][sample].tolist()
            words = [text[i:j].decode() for i, j in zip(a, b, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([*words, *counts], pa.string()), pa.array([*n.tolist(), *counts.values()], pa.int64())], ["word", "n"])

    return docs.mapInArrow(run, "word string, n bigint")


# --- partitions by initial state -----------------------------------------------

#: ``most`` code points are the pair's longer word; ``head`` and ``tail`` of them are shared; pairs that share ``other`` (0: none) belong elsewhere.
_STATE = ["most", "head", "tail", "other"]


def _split(rows: DataFrame) -> DataFrame:
    """Each row's two later initial states: half of what is left goes to the head or to the tail."""
    half = "(most - head - tail) div 2"
    kinds = F.array(
        F.struct((F.expr(f"head + {half}")).alias("head"), F.col("tail").alias("tail"), F.col("other").alias("other")),
        F.struct(F.col("head").alias("head"), F.expr(f"tail + {half}").alias("tail"), F.expr(f"head + {half}").alias("other")))
    out = rows.select("word", "n", "most", F.explode(kinds).alias("to")).select("word", "n", "most", "to.*")
    # Pairs that share the head are another partition's already.
    out = out.where("other = 0 or other > head")
    return out.withColumn("key", F.concat_ws(" ", *[F.col(c).cast("string") for c in _STATE],
                                             F.expr("substring(word, 1, head)"), F.expr("substring(word, length(word) - tail + 1, tail)")))


def partitions(words: DataFrame, largest: int = LARGEST) -> DataFrame:
    """``key, word, n``: the partitions of all words, none but the last kind larger than ``largest``."""
    every = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("most"))
    rows = materialize(_split(every.select("*", F.lit(0).alias("head"), F.lit(0).alias("tail"), F.lit(0).alias("other"))), "spelling-partitions")
    done = []
    while True:
        large = materialize(rows.where("most - head - tail > 2").groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > largest).select("key"), "spelling-large")
        if large.isEmpty():
            done.append(rows)
            break
        done.append(rows.join(large, "key", "left_anti"))
        rows = materialize(_split(rows.join(large, "key", "left_semi").drop("key")), "spelling-partitions")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("key", "word", "n")


# --- acceptors and their composition -------------------------------------------

class Acceptor:
    """Minimised acceptors over one set of states; words of one acceptor have the same length, state 0 accepts."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = [{}]
        self.known: dict[tuple, int] = {}
        self.endings: dict[int, list[str]] = {0: [""]}
        self.common: dict[tuple[int, int], list[str]] = {}
        self.changed: dict[int, list[tuple[str, str]]] = {}
        self.shortened: dict[tuple[int, int], set[tuple[str, str]]] = {}

    def state(self, words: list[str], at: int = 0) -> int:
        """The state that accepts the rest of sorted distinct ``words`` behind ``at``."""
        if at == len(words[0]):
            return 0
        if len(words) == 1:
            arcs = {words[0][at]: self.state(words, at + 1)}
        else:
            arcs = {c: self.state(list(g), at + 1) for c, g in groupby(words, key=lambda w: w[at])}
        key = tuple(arcs.items())
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
        return found

    def accepted(self, a: int) -> list[str]:
        if a not in self.endings:
            self.endings[a] = [c + e for c, to in self.arcs[a].items() for e in self.accepted(to)]
        return self.endings[a]

    def shared(self, a: int, b: int) -> list[str]:
        """What both states accept: the composition behind the edit."""
        if a == b:
            return self.accepted(a)
        key = (a, b) if a < b else (b, a)
        found = self.common.get(key)
        if found is None:
            of_a, of_b = self.arcs[a], self.arcs[b]
            found = [c + e for c in of_a.keys() & of_b.keys() for e in self.shared(of_a[c], of_b[c])]
            self.common[key] = found
        return found

    def replaced(self, a: int) -> list[tuple[str, str]]:
        """Pairs of words from ``a`` that differ by one replaced letter, each once."""
        if a in self.changed:
            return self.changed[a]
        arcs = list(self.arcs[a].items())
        found = self.changed[a] = []
        for i, (c, to) in enumerate(arcs):
            for d, other in arcs[:i]:
                found += [(c + e, d + e) for e in self.shared(to, other)]
            found += [(c + x, c + y) for x, y in self.replaced(to)]
        return found

    def deleted(self, a: int, b: int) -> set[tuple[str, str]]:
        """Pairs of a word from ``a`` and one from ``b`` that lacks one of its letters."""
        if (a, b) in self.shortened:
            return self.shortened[a, b]
        found = self.shortened[a, b] = set()
        of_b = self.arcs[b]
        for c, to in self.arcs[a].items():
            found.update((c + e, e) for e in self.shared(to, b))
            if c in of_b:
                found.update((c + x, c + y) for x, y in self.deleted(to, of_b[c]))
        return found


def compose(key: str, words: list[str]) -> Iterator[tuple[int, int]]:
    """The pairs of one partition, as positions in its sorted ``words``."""
    most, head, tail, other = map(int, key.split(" ")[:4])
    rest: tuple[dict[str, int], dict[str, int]] = ({}, {})
    for i, w in enumerate(words):
        rest[most - len(w)][w[head:len(w) - tail]] = i
    longer, shorter = rest
    if not longer or len(words) < 2:
        return
    acceptor = Acceptor()
    root = acceptor.state(sorted(longer))
    pairs = [(longer[x], longer[y]) for x, y in acceptor.replaced(root)]
    if shorter:
        below = acceptor.state(sorted(shorter))
        pairs += [(longer[x], shorter[y]) for x, y in acceptor.deleted(root, below)]
    for i, j in pairs:
        # Whole words are compared: what they share may reach into the tail.
        if not other or words[i][:other] != words[j][:other]:
            yield i, j


def near(postings: DataFrame) -> DataFrame:
    """``word, n_near, best_n, best``: for each word of each partition, how many it is near to there, and the most frequent of them."""

    def found(key: str, words: list[str], n: list[int]) -> Iterator[tuple]:
        count, best = [0] * len(words), [-1] * len(words)
        for i, j in compose(key, words):
            for x, y in ((i, j), (j, i)):
                count[x] += 1
                if best[x] < 0 or (n[y], -y) > (n[best[x]], -best[x]):
                    best[x] = y
        for i, c in enumerate(count):
            if c:
                yield words[i], c, n[best[i]], words[best[i]]

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                          ["word", "n_near", "best_n", "best"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, words, n, out = None, [], [], []
        for batch in batches:
            keys = pc.run_end_encode(batch.column(0))
            all_words, all_n, lo = batch.column(1).to_pylist(), batch.column(2).to_pylist(), 0
            for hi, k in zip(keys.run_ends.to_pylist(), keys.values.to_pylist(), strict=True):
                if k != key:
                    if len(words) > 1:
                        out.extend(found(key, words, n))
                    key, words, n = k, [], []
                words += all_words[lo:hi]
                n += all_n[lo:hi]
                lo = hi
                if len(out) > 50_000:
                    yield rows(out)
                    out = []
        if len(words) > 1:
            out.extend(found(key, words, n))
        yield rows(out)

    ordered = postings.repartition("key").sortWithinPartitions("key", "word")
    return ordered.mapInArrow(run, "word string, n_near bigint, best_n bigint, best string")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form`` rows (no null form): the last word that forms lead to."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = materialize(at.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        discard(at)
        at = step
        if step.where("moved").isEmpty():
            return step.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", largest: int = LARGEST) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of at least 5 code points and 3 occurrences."""
    ship_package(docs.sparkSession)
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    words = spelled(docs).groupBy("word").agg(F.sum("n").alias("n")).where((F.col("n") >= LEAST_TIMES) & (F.length("word") >= LEAST_LETTERS))
    words = materialize(words, "spelling-words")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    found = near(partitions(words, largest)).groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    is_form = -F.col("b.minus") >= 2 * F.col("n")
    formed = materialize(words.join(found, "word", "left").select(
        "word", F.when(is_form, F.col("b.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("b.minus")).alias("form_n")), "spelling-forms")
    ends = roots(formed.where("form is not null").select("word", "form"))
    return formed.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
