import random

import duckdb
import numpy as np
import pytest

from tagpulse.llm import ngram_join as J
from tests.llm.helpers import ODD_TEXTS, documents, prose, words


def shingles(text, n):
    w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in words(text)]
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = [(d, shingles(t, n)) for d, t in rows]
    label = {d: d for d, _ in rows if d is not None}
    edges = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y)]
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted(((d, len(s), label.get(d)) for d, s in sets), key=str)


def corpus(seed, n_groups=12, members=14):
    """Groups of copies with a few edits each, so that likeness lies around the thresholds."""
    rng, texts = random.Random(seed), []
    for _ in range(n_groups):
        base = prose(rng, rng.choice([12, 40, 90])).split()
        for _ in range(rng.randrange(1, members)):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                w[rng.randrange(len(w))] = f"e{rng.randrange(30)}"
            texts.append(" ".join(w))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize(("n", "percent", "seed"), [(3, 90, 1), (5, 80, 2), (3, 50, 3), (1, 80, 4)])
def test_components_equal_brute_force(spark, n, percent, seed):
    rows = list(enumerate([*corpus(seed), *ODD_TEXTS, "ONE", "Two Words", *ODD_TEXTS]))
    found = J.linked(documents(spark, rows), n, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, n, percent)


def test_large_group_of_near_copies_is_linked_whole(spark):
    rng = random.Random(5)
    base = prose(rng, 120).split()
    rows = []
    for i in range(150):
        w = list(base)
        w[rng.randrange(len(w))] = f"only{i}"
        rows.append((i, " ".join(w)))
    found = J.linked(documents(spark, rows).repartition(6), 3, 90).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute(rows, 3, 90)


def test_null_and_repeated_ids(spark):
    text = prose(random.Random(6), 30)
    rows = [(None, text), (4, text), (4, text), (9, text), (4, "other words here"), (None, None)]
    found = sorted(((r.doc_id, r.component_id) for r in J.linked(documents(spark, rows), 3, 90).collect()), key=str)
    assert found == sorted([(None, None), (None, None), (4, 4), (4, 4), (4, 4), (9, 4)], key=str)


def near_copies(rng, size=60):
    base = prose(rng, size).split()
    return " ".join(base), " ".join([*base[:-1], "changed"])


def test_unrelated_pairs_repeated_over_partitions(spark):
    rng = random.Random(9)
    rows = list(enumerate([t for _ in range(6) for t in near_copies(rng)], 1))
    found = J.linked(documents(spark, rows).union(documents(spark, rows)), 3, 90).collect()
    assert sorted({(r.doc_id, r.component_id) for r in found}) == [(i, i - 1 + i % 2) for i in range(1, 13)]
    assert len(found) == 24


def test_lists_that_differ_in_a_repeated_id(spark):
    rng = random.Random(10)
    (five, one), (six, two) = near_copies(rng), near_copies(rng)
    part = [(5, five), (6, six), (7, one), (7, two)]
    found = J.linked(documents(spark, part).union(documents(spark, part[:2])), 3, 90).collect()
    assert {r.component_id for r in found} == {5}


def test_empty_table(spark):
    assert J.linked(documents(spark, []), 3, 90).count() == 0


def test_sql_agrees_with_brute_force(spark):
    rows = list(enumerate([*corpus(7, 6, 8), *ODD_TEXTS]))
    documents = __import__("pandas").DataFrame(rows, columns=["doc_id", "text"])  # noqa: F841
    con = duckdb.connect()
    con.register("documents", documents)
    assert sorted(con.execute(J.linked_sql(3, 90)).fetchall(), key=str) == brute(rows, 3, 90)


def test_suffix_bound_is_a_lower_bound():
    rng = np.random.default_rng(8)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(2))
        assert J.suffix_bound(a, b) <= len(np.setxor1d(a, b))
        both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if len(a) and len(b):
            assert J.alike(a, b, 80) == (100 * both >= 80 * either)
