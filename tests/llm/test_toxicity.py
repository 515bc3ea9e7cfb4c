import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagpulse.llm import toxicity as X
from tests.llm.helpers import ODD_TEXTS, documents


def maximal(scores, lo=0):
    """All maximal scoring segments by definition: the best one, then both sides of it."""
    best = max(((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, _, i, j = best
    return [*maximal(scores[:i], lo), (lo + i, lo + j, best[0]), *maximal(scores[j:], lo + j)]


def test_segments_equal_the_definition():
    for seed in range(200):
        rng = random.Random(seed)
        scores = [float(rng.choice([-3, -2, -1, 1, 2, 4])) + rng.random() / 1000 for _ in range(rng.randrange(0, 14))]
        found = X.segments(np.array(scores))
        want = maximal(scores)
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in found], [s for *_, s in want])


def test_extreme_rate_solves_its_equation():
    weights, share = np.array([-1.0, 0.5, 2.0], np.float32), np.array([0.9, 0.08, 0.02])
    rate = X.extreme_rate(weights, share)
    assert abs((share * np.exp(rate * weights)).sum() - 1) < 1e-6


def corpus(seed, n=400):
    rng = random.Random(seed)
    slurs = ["vilmo", "grotch", "spunder"]
    rows, marks = [], []
    for i in range(n):
        toxic = i % 5 == 0
        w = [f"w{int(rng.paretovariate(0.8)) % 500}" for _ in range(rng.randrange(20, 120))]
        if toxic:
            at = rng.randrange(len(w))
            w[at:at] = [rng.choice(slurs) + rng.choice(["", "s", "ing", "est"]) for _ in range(4)]
        rows.append((i, " ".join(w)))
        marks.append((i, int(toxic)))
    return rows, marks


def test_learns_passages_and_separates(spark):
    rows, marks = corpus(1)
    labels = spark.createDataFrame([m for m in marks if zlib.crc32(str(m[0]).encode()) % 5] + [(None, 1), (0, None)], "doc_id long, toxic int")
    df = documents(spark, rows + [(5000 + i, t) for i, t in enumerate(ODD_TEXTS)]).repartition(3)
    model = X.learn(df, labels)
    found = {r.doc_id: r for r in X.score(df, model).collect()}
    assert len(found) == len(rows) + len(ODD_TEXTS)
    held = [m for m in marks if not zlib.crc32(str(m[0]).encode()) % 5]
    assert np.mean([(found[i].score >= 0.5) == t for i, t in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    assert all(found[5000 + i].score < 0.5 for i in range(len(ODD_TEXTS)))
    kept = {r.doc_id for r in X.reject(df, model).collect()}
    assert kept == {i for i, r in found.items() if r.score < 0.5}
    assert X.reject(df, model).columns == df.columns


def all_forms(text):
    """Each token of a text as the set of itself and its stems."""
    found = re.findall(rb"[a-z0-9\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    return [{w, *[(n, w[:n]) for n in X.STEMS if len(w) > n]} for w in found]


def brute_force(rows, groups):
    """Scores by plain loops; ``groups`` has ``(half, label)`` by id."""
    texts = [(d, all_forms(t)) for d, t in rows]
    held = Counter(f for d, tokens in texts if d in groups for f in set().union(*tokens))
    known = {f for f, n in held.items() if n >= X.LEAST_DOCS}
    counts = {g: Counter() for g in ("all", (0, 0), (0, 1), (1, 0), (1, 1))}
    for d, tokens in texts:
        forms = {f if f in known else None for f in set().union(*tokens)}
        counts["all"].update(forms)
        if d in groups:
            counts[groups[d]].update(forms)
    names = sorted(known, key=repr) + [None]
    corpus = [counts["all"][f] + 1e-3 for f in names]

    def weigh(toxic, other):
        mass = X.PRIOR_SHARE * (sum(toxic.values()) + sum(other.values()) + 1)
        prior = {f: mass * c / sum(corpus) for f, c in zip(names, corpus, strict=True)}
        a, b = ({f: n[f] + prior[f] for f in names} for n in (toxic, other))
        total_a, total_b, out = sum(a.values()), sum(b.values()), {}
        for f in names:
            gap = math.log(a[f] / (total_a - a[f])) - math.log(b[f] / (total_b - b[f]))
            size = max(abs(gap) - X.SHRINK * math.sqrt(1 / a[f] + 1 / b[f]), 0)
            out[f] = float(np.float32(math.copysign(size, gap) - X.TOKEN_COST if f is not None else -X.TOKEN_COST))
        share = np.array([other[f] + 0.02 for f in names])
        return out, X.extreme_rate(np.array([out[f] for f in names], np.float32), share)

    def evidence(tokens, weights, rate):
        scores = [max(weights.get(f, weights[None]) for f in forms) for forms in tokens]
        found = [rate * total - math.log(len(scores)) for _, _, total in maximal(scores)]
        above = [e for e in found if e > 0]
        return sum(above) if above else max([X.LEAST, *found])

    halves = [weigh(counts[h, 1], counts[h, 0]) for h in (0, 1)]
    histogram = np.zeros((2, X.BINS), int)
    for d, tokens in texts:
        if d in groups:
            half, label = groups[d]
            value = evidence(tokens, *halves[1 - half])
            histogram[label, min(int((value - X.LEAST) / X.BIN_WIDTH), X.BINS - 1)] += 1
    intercept, slope = X._fit(histogram)
    final = weigh(counts[0, 1] + counts[1, 1], counts[0, 0] + counts[1, 0])
    return {d: 1 / (1 + math.exp(-(intercept + slope * evidence(tokens, *final)))) for d, tokens in texts}


def test_scores_equal_brute_force(spark):
    rows, marks = corpus(3, 120)
    rows = [(d, " ".join(t.split()[:25])) for d, t in rows] + [(900, None), (901, "Grotch GROTCHES, grotching é Ünd"), (902, "")]
    df = documents(spark, rows).repartition(3)
    labels = spark.createDataFrame([m for m in marks if m[0] % 4], "doc_id long, toxic int")
    half = {r.doc_id: r.h for r in df.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).alias("h")).collect()}
    want = brute_force(rows, {d: (half[d], t) for d, t in marks if d % 4})
    found = {r.doc_id: r.score for r in X.score(df, X.learn(df, labels)).collect()}
    assert found.keys() == want.keys()
    assert [found[d] for d in want] == pytest.approx(list(want.values()), abs=1e-4)


def test_vocabulary_places():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 3000, np.uint64) << np.uint64(1)
    book = X.Vocabulary(np.concatenate([hashes[:2000], hashes[:50]]))
    places = book.places(hashes.reshape(2, -1)).ravel()
    assert len(book) == 2000 and (book.hashes[places[:2000]] == hashes[:2000]).all() and (places[2000:] == 2000).all()
    assert X.Vocabulary(hashes[:0]).places(hashes).tolist() == [0] * 3000


def test_fold_is_the_checksum(spark):
    rows = spark.range(50).withColumn("f", X.fold(__import__("pyspark.sql.functions", fromlist=["col"]).col("id"))).collect()
    assert [r.f for r in rows] == [zlib.crc32(str(r.id).encode()) % 5 for r in rows]


def test_one_class_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    df = documents(spark, [(1, "some text"), (1, "some text"), (None, None)])
    scores = [r.score for r in X.score(df, X.learn(df, none)).collect()]
    assert len(scores) == 3 and len(set(scores)) == 1
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r.score < 0.5 for r in X.score(df, X.learn(df, one)).collect()} == {True}
    empty = documents(spark, [])
    assert X.score(empty, X.learn(empty, none)).count() == 0


def test_held_out_accuracy_on_the_given_labels(spark):
    from tagpulse.llm.queries import op3_toxicity
    d = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    found = [r for r in op3_toxicity(spark, d).collect() if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in found)
    caught = [r.predicted for r in found if truth[r.doc_id] == 1]
    assert right / len(found) >= 0.95 and sum(caught) / len(caught) >= 0.75
