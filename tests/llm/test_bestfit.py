import random

from tagpulse.llm import bestfit as B
from tests.llm.helpers import ODD_TEXTS, documents, prose, words


def naive(items, capacity):
    """Best fit by looking at every bin."""
    bins, out = [], []
    for size, source, cluster in items:
        fits = [(b["room"], i) for i, b in enumerate(bins) if b["room"] >= size and source not in b["s"] and cluster not in b["c"]]
        if not fits:
            bins.append({"room": capacity, "s": set(), "c": set()})
            fits = [(capacity, len(bins) - 1)]
        _, i = min(fits)
        out.append((i, capacity - bins[i]["room"]))
        bins[i]["room"] -= size
        bins[i]["s"].add(source)
        bins[i]["c"].add(cluster)
    return out


def test_pack_equals_naive_best_fit():
    for seed in range(30):
        rng = random.Random(seed)
        items = sorted(((rng.randrange(0, 101), rng.choice([0, 0, 1, 2, 3, 4]), rng.randrange(0, 25)) for _ in range(120)), reverse=True)
        assert B.pack(items, 100) == naive(items, 100)


def test_bins_hold_whole_texts_without_conflicts(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, rng.choice([3, 20, 90, 250])), rng.choice([None, "a", "b", "c"])) for i in range(300)]
    rows += [(1000 + i, rows[0][1], "abc"[i % 3]) for i in range(30)] + [(2000 + i, t, None) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id", "a"), (5, "again", "a")]
    found = B.best_fit(documents(spark, rows), capacity=100, group_rows=150).collect()
    bins, total = {}, {}
    for r in found:
        bins.setdefault((r.group_id, r.bin), []).append(r)
        total[r.doc_id] = total.get(r.doc_id, 0) + r.piece_size
    expected = {}
    for d, t, _ in rows:
        expected[d] = expected.get(d, 0) + len(words(t))
    assert total == expected
    for held in bins.values():
        at = 0
        for r in sorted(held, key=lambda r: (r.start, r.piece_size)):
            assert r.start == at
            at += r.piece_size
        assert at <= 100
        assert len({r.source for r in held}) == len(held)
        assert len({r.cluster for r in held}) == len(held)


def test_a_hot_id_is_dealt_to_many_groups(spark):
    rows = [(i, f"one two {i}", "abc"[i % 3]) for i in range(4000)]
    rows += [(None, "the very same row", "a")] * 1500 + [(None, f"no id {i}", "b") for i in range(500)] + [(7, "a repeated row", "c")] * 1000
    found = B.best_fit(documents(spark, rows), capacity=40, group_rows=500).toPandas()
    assert len(found) == len(rows)
    assert found.groupby("group_id").size().max() <= 2 * 500
    assert (found["doc_id"].isna().sum(), (found["doc_id"] == 7).sum()) == (2000, 1001)
    assert not found.duplicated(["group_id", "bin", "cluster"]).any()


def test_whole_query_equals_best_fit_over_all_bins_of_each_group(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, rng.choice([0, 2, 9, 35, 90])), rng.choice([None, "a", "b", "c"])) for i in range(250)]
    rows += [(5, rows[5][1], rows[5][2])] * 3 + [(None, "no id at all", "a")] * 2
    found = B.best_fit(documents(spark, rows), capacity=30, group_rows=120).toPandas()
    assert sorted(found["group_id"].unique()) == [0, 1, 2]
    for _, group in found.groupby("group_id"):
        last = group[group["piece"] == group["pieces"] - 1].sort_values(
            ["piece_size", "doc_id", "cluster", "source"], ascending=[False, True, True, True], kind="stable")
        items = list(zip(last["piece_size"], last["source"].fillna(""), last["cluster"], strict=True))
        assert sorted(zip(last["bin"], last["start"], strict=True)) == sorted(naive(items, 30))
        full = group[group["piece"] < group["pieces"] - 1]
        assert (full["piece_size"] == 30).all() and full["bin"].is_unique and not set(full["bin"]) & set(last["bin"])
    assert found["piece_size"].sum() == sum(len(words(t)) for _, t, _ in rows)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "a b", "s", 9, 9, 9, 9)], "doc_id long, text string, source string, size int, group_id int, copies int, run int")
    (row,) = B.best_fit(df).collect()
    assert (row.doc_id, row["size"], row.piece_size) == (1, 2, 2)


def test_empty_table(spark):
    assert B.best_fit(documents(spark, [])).count() == 0
