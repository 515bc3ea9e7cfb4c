import random

import pytest

from tagpulse.llm import mixing as M
from tests.llm.helpers import documents, words


def levels(sizes, epochs=3):
    """Targets by sharing again and again: clamp whoever is above, share the excess by weight."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / w for s in free}
        above = [s for s in free if share[s] > epochs * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: epochs * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_takes(spark, seed):
    rng = random.Random(seed)
    sources = [None, "a", "B", "é", "zz", "s10", "s2"][: 3 + 2 * seed]
    rows = [(i, " ".join("w" * rng.randrange(1, 4) for _ in range(rng.randrange(0, 30))), rng.choice(sources + sources[:1] * 5)) for i in range(400)]
    rows += [(1000, None, "a"), (None, "no id", "a"), (1001, "", None)]
    found = M.shares(documents(spark, rows).repartition(3)).collect()
    assert len(found) == len(rows)
    source = {r[0]: (r[2], len(words(r[1]))) for r in rows}
    sizes = {s: sum(n for t, n in source.values() if t == s) for s in {r[2] for r in rows}}
    expected = levels(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        s, n = source[r.doc_id]
        assert r.size == n and r.source_size == sizes[s]
        assert r.target == pytest.approx(expected[s])
        assert r.taken % max(n, 1) == 0 and r.taken <= 3 * n
        taken[s] += r.taken
    for s, t in taken.items():
        assert abs(t - expected[s]) <= 15, (s, t, expected[s])
    again = M.shares(documents(spark, rows).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_mix_repeats_rows_with_their_columns(spark):
    rows = [(i, "word " * 10, "small" if i < 3 else "tiny" if i < 4 else "large") for i in range(40)]
    df = documents(spark, rows)
    out = M.mix(df)
    assert out.columns == df.columns
    times = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    shares = {r.doc_id: r.taken // 10 for r in M.shares(df).collect() if r.taken}
    assert times == shares
    assert max(times.values()) <= 3


def test_no_words_and_no_rows(spark):
    assert [r.target for r in M.shares(documents(spark, [(1, ""), (2, None)])).collect()] == [0.0, 0.0]
    assert M.shares(documents(spark, [])).count() == 0
    assert M.mix(documents(spark, [])).count() == 0
