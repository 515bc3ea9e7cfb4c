import math
import random

import numpy as np
import pytest

from tagpulse.llm import cross_polytope as C


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, bucket int, rep string")


def brute(rows, k=5, every=50):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in ok:
        if i % every == 0:
            near = sorted((-(v @ w / np.linalg.norm(v) / np.linalg.norm(w)).round(9), j) for j, w in ok if j != i and len(w) == len(v))
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def found(df, **options):
    out = {}
    for r in sorted(C.search(df, lambda key: key % 50 == 0, **options).collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in v] for q, v in out.items()}


def same(got, want):
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items() if v}
    for q, v in got.items():
        assert [s for _, s in v] == pytest.approx([s for _, s in want[q]], abs=1e-8)


def test_hadamard_keeps_lengths_and_angles():
    x = np.random.default_rng(1).normal(size=(20, 48))
    y = C.rotate(x, 3, 0)
    assert np.allclose(x @ x.T, y @ y.T)


def test_probes_begin_with_the_own_bucket():
    x = np.random.default_rng(2).normal(size=(50, 16))
    for hashes in (1, 2, 3):
        p = C.probes(x, 5, hashes, 4)
        assert (p[:, 0] == C.buckets(x, 5, hashes)).all()
        assert p.shape[1] == 4 ** hashes and all(len(set(r)) == len(r) for r in p.tolist())


def test_recall_and_exact_scores(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = found(df), brute(rows)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in v}) for q, v in want.items())
    assert hits / sum(map(len, want.values())) >= 0.9
    exact = {i: np.array(v, float) for i, v in rows}
    for q, v in got.items():
        for i, s in v:
            assert s == pytest.approx(exact[q] @ exact[i] / np.linalg.norm(exact[q]) / np.linalg.norm(exact[i]), abs=1e-12)


def test_odd_rows_ties_and_copies(spark):
    rng = random.Random(3)
    base = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, list(base)) for i in range(0, 400)]  # copies, eight of them queries
    rows += [(1000, [2 * x for x in base]), (1001, [-x for x in base]), (1002, None), (1003, [0.0] * 8), (1004, [None, *base[1:]]),
             (1005, [math.nan, *base[1:]]), (1006, [math.inf, *base[1:]]), (None, base), (1050, [1.0, 0.0, 0.0]), (1051, [1.0, 1.0, 0.0]), (1100, [1.0] * 5)]
    rows += [(2000 + i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(60)]
    got = found(vectors(spark, rows).repartition(4))
    want = brute(rows)
    same({q: v for q, v in got.items() if q < 2000}, {q: v for q, v in want.items() if q < 2000})


def test_few_vectors_are_all_found(spark):
    rng = random.Random(4)
    rows = [(i * 50, [rng.gauss(0, 1) for _ in range(16)]) for i in range(5)]
    same(found(vectors(spark, rows)), brute(rows))
    assert found(vectors(spark, [(0, [1.0, 2.0])])) == {}
    assert found(vectors(spark, [])) == {}


def test_large_buckets_are_cut_into_pieces(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, [1 + rng.gauss(0, 0.05) for _ in range(8)]) for i in range(300)]
    whole = found(vectors(spark, rows))
    monkeypatch.setattr(C, "PIECE_ROWS", 16)
    assert found(vectors(spark, rows)) == whole


def test_more_hashes_for_more_vectors(spark, monkeypatch):
    assert [C.geometry(n, 64) for n in (1, 50_000, 10_000_000, 10**9)] == [1, 1, 2, 3]
    rng = random.Random(6)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(20)]
    rows = [(i, [x + rng.gauss(0, 0.05) for x in centres[i % 20]]) for i in range(600)]
    monkeypatch.setattr(C, "BUCKET_ROWS", 2)
    got, want = found(vectors(spark, rows)), brute(rows)
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in v}) for q, v in want.items()) / sum(map(len, want.values())) >= 0.9


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in v}) for q, v in want.items()) / sum(map(len, want.values()))


@pytest.mark.parametrize(("hashes", "bucket_rows", "every"), [(2, 1, 50), (3, 0.01, 500)])
def test_recall_of_more_hashes_on_the_given_vectors(spark, monkeypatch, hashes, bucket_rows, every):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    monkeypatch.setattr(C, "BUCKET_ROWS", bucket_rows)
    assert C.geometry(len(rows), 64) == hashes
    got = {}
    for r in C.search(df, lambda key: key % every == 0).collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    print(hashes, "hashes: recall", found_share := recall(got, brute(rows, every=every)))
    assert found_share >= 0.9


def test_probes_reach_the_nearest_by_any_number_of_hashes(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    at, x = {i: n for n, (i, _) in enumerate(rows)}, np.array([v for _, v in rows], float)
    want = brute(rows)
    asked = x[[at[q] for q in want]]
    near = np.array([[at[i] for i, _ in v] for v in want.values()])
    for hashes, count in enumerate(C.PROBES, 1):
        hit, seen = np.zeros(near.shape, bool), np.zeros((len(asked), len(x)), bool)
        for t in range(C.TABLES):
            own = C.buckets(x, t, hashes)
            for n, p in enumerate(C.probes(asked, t, hashes, count)):
                hit[n] |= np.isin(own[near[n]], p)
                seen[n] |= np.isin(own, p)
        print(hashes, "hashes: recall", hit.mean(), "compared", seen.mean())
        assert hit.mean() >= 0.9
