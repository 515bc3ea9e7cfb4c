import math
import random
import re
from collections import Counter

import pytest

from tagpulse.llm import ranked_search as R
from tests.llm.helpers import ODD_TEXTS, documents, prose

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags]
    n_docs, length = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        rows = []
        for d, b, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m)) for t in terms(text) if t in b)
            if s > 0 and d is not None:
                rows.append((-s, d))
        out += [(item, r, d, -s) for r, (s, d) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


def corpus():
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.randrange(1, 60), 80)) for i in range(200)]
    rows += [(500 + i, rows[3][1].upper() + "!") for i in range(150)]          # one bag, many documents
    rows += [(1000 - i, "w1, w2; w3") for i in range(60)] + [(1100 + i, f"w1 w2 w3 x{i}") for i in range(5)]
    rows += [(2000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(7, "w5 again"), (7, "w5 again"), (None, "w1 w2 w3 w9")]
    items = [(i, prose(rng, rng.randrange(1, 40), 90)) for i in range(25)] + [(30, rows[3][1]), (31, "w1 w2 w3 w3"), (32, None), (33, ""), (34, "nowhere"), (35, "the one ärger ÄRGER"), (31, "w7")]
    return rows, items


@pytest.mark.parametrize("block,matrix", [(R.BLOCK, R.MATRIX), (120, 700)])
def test_equals_brute_force(spark, monkeypatch, block, matrix):
    monkeypatch.setattr(R, "MATRIX", matrix)
    rows, items = corpus()
    docs = documents(spark, rows).repartition(7)
    asked = spark.createDataFrame([(i, t, 1.0, "x") for i, t in items], "item_id long, text string, score double, rank string")
    got = sorted((tuple(r) for r in R.search(docs, asked, block=block).select("item_id", "rank", "doc_id", "score").collect()), key=str)
    assert got == brute(rows, items)
    assert len({i for i, *_ in got}) >= 20


def test_fewer_documents_than_asked(spark):
    docs = documents(spark, [(2, "alpha beta"), (1, "alpha beta"), (3, "gamma")])
    items = spark.createDataFrame([(9, "beta")], "item_id long, text string")
    assert [(r["rank"], r["doc_id"]) for r in R.search(docs, items).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_equal_bags_are_scored_once(spark):
    docs = documents(spark, [(i, "alpha beta gamma" if i % 3 else f"alpha w{i}") for i in range(90)])
    asked = []
    real = R.best_classes

    def spy(classes, items, k):
        asked.append(classes.count())
        return real(classes, items, k)

    R.best_classes = spy
    try:
        R.search(docs, spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")).collect()
    finally:
        R.best_classes = real
    assert asked == [2]
