import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagpulse.llm import lm_scoring as M
from tests.llm.helpers import ODD_TEXTS, documents, words

END = object()
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*words((text or "").translate(LOWER)), END]


def crc(d):
    return zlib.crc32(("" if d is None else str(d)).encode())


def bucket(c):
    return c.bit_length()


class Brute:
    def __init__(self, rows):
        self.rows = [(d, tokens(t)) for d, t in rows]
        self.one, self.two = Counter(), Counter()
        for d, t in self.rows:
            if crc(d) % 7 != 2:
                self.one.update(t)
                self.two.update(zip([END, *t], t))
        self.n, self.v = sum(self.one.values()), len(self.one)

    def weights(self):
        """The weights by EM on the counts of all training documents but the one that is scored."""
        events = {}
        for d, t in self.rows:
            if crc(d) % 7 == 2 or (crc(d) // 7) % M.DELETED:
                continue
            one, two = Counter(t), Counter(zip([END, *t], t))
            for v, w in zip([END, *t], t):
                seen = self.one[v] - one[v]
                f2 = (self.two[v, w] - two[v, w]) / seen if seen else 0
                f1 = (self.one[w] - one[w]) / max(1, self.n - len(t))
                events.setdefault(bucket(seen), []).append((f2, f1, 1 / (self.v + 1)))
        out = []
        for b, rows in events.items():
            f, w = np.array(rows), np.array([1 / 3] * 3 if b else [0, 0.5, 0.5])
            for _ in range(M.EM_ROUNDS):
                share = f * w
                e = (share / share.sum(1, keepdims=True)).sum(0) + (w > 0)
                w = e / e.sum()
            out.append((b, *w))
        return M.weights_table(out)

    def p(self, v, w, weights):
        seen = self.one[v]
        l2, l1, l0 = weights[bucket(seen)]
        return l2 * (self.two[v, w] / seen if seen else 0) + l1 * self.one[w] / max(1, self.n) + l0 / (self.v + 1)

    def scores(self, weights):
        for d, t in self.rows:
            yield (d, crc(d) % 7 == 2, len(t), sum(self.one[w] > 0 for w in t), self.n, sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in t),
                   sum(math.log10(self.p(v, w, weights)) for v, w in zip([END, *t], t)))


def corpus(n=700):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(n):
        text, w = [], rng.randrange(150)
        for _ in range(rng.randrange(1, 50)):
            w = (3 * w + rng.randrange(6)) % 150 if rng.random() < 0.8 else rng.randrange(150)
            text.append(vocabulary[w] if rng.random() < 0.97 else f"new{rng.randrange(10**6)}")
        rows.append((i, " ".join(text).title() if i % 5 else " ".join(text)))
    rows += [(10_000 + i, rows[5][1]) for i in range(40)]
    return rows + [(20_000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(3, "a row with a used id"), (None, "no id w1 w2")]


def ordered(rows):
    return sorted(rows, key=lambda r: (str(r[0]), r[2], r[6]))


@pytest.mark.parametrize("chunk,bucket_bytes", [(M.CHUNK, M.BUCKET_BYTES), (900, 4000)])
def test_equals_brute_force(spark, monkeypatch, chunk, bucket_bytes):
    monkeypatch.setattr(M, "CHUNK", chunk)
    monkeypatch.setattr(M, "BUCKET_BYTES", bucket_bytes)
    rows = corpus()
    brute = Brute(rows)
    docs = documents(spark, rows).repartition(3)
    found = M.count(docs, M.held_out_fold(F.col("doc_id")), M.deleted_part(F.col("doc_id")))
    assert (found.totals.n, found.totals.v) == (brute.n, brute.v)
    weights = M.learn_weights(found)
    assert np.allclose(weights, brute.weights(), atol=0.02)
    got = ordered(map(tuple, M.score(docs).collect()))
    want = ordered(brute.scores(weights))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)
    held = [r for r in got if r[1] and r[2] > 1]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_the_model_sums_to_one():
    brute = Brute(corpus(200))
    weights = brute.weights()
    for v in [END, "w1", "never seen", "w77"]:
        total = sum(brute.p(v, w, weights) for w in brute.one) + brute.p(v, "an unknown word", weights)
        assert abs(total - 1) < 1e-9


def test_held_out_documents_teach_nothing(spark):
    rows = [(i, "common words here") for i in range(30)]
    held = [i for i, _ in rows if crc(i) % 7 == 2]
    docs = documents(spark, [(i, "secret secret" if i in held else t) for i, t in rows])
    got = M.score(docs).where("held_out").collect()
    assert len(got) == len(held) and all(r["n_known"] == 1 and r["n_tokens"] == 3 for r in got)


def test_all_held_out(spark):
    only = next(i for i in range(100) if crc(i) % 7 == 2)
    (row,) = M.score(documents(spark, [(only, "a b")])).collect()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and math.isfinite(row["score"]) and row["base_score"] == 0


def test_weights_of_buckets_without_any():
    table = M.weights_table([(3, 0.5, 0.3, 0.2), (6, 0.7, 0.2, 0.1)])
    assert table[1].tolist() == table[5].tolist() == [0.5, 0.3, 0.2] and table[40].tolist() == [0.7, 0.2, 0.1] and table[0].tolist() == [0, 0.5, 0.5]
