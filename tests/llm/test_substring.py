import hashlib
import random
from collections import Counter

import pytest

from tagpulse.llm import substring as S
from tests.llm.helpers import ODD_TEXTS, documents, prose, words


def brute(rows, window):
    split = [words(t) for _, t in rows]
    count = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, split):
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def run(df, window):
    rows = S.cut(df, S.kept_digest, "kept_sha256", window).collect()
    return sorted(((r.row.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def corpus(seed):
    rng = random.Random(seed)
    passages = [prose(rng, n) for n in (20, 34, 35, 36, 60, 120)]
    texts = []
    for _ in range(60):
        parts = [prose(rng, rng.randrange(0, 60))]
        for _ in range(rng.randrange(0, 3)):
            p = rng.choice(passages).split()
            a = rng.randrange(0, 10)
            parts += [" ".join(p[a:]) if rng.random() < 0.5 else " ".join(p), prose(rng, rng.randrange(0, 30))]
        texts.append(" ".join(parts))
    return texts + texts[:9] + ["\n".join(texts[0].split()), "again " * 100, "ab cd " * 60, "again " * 36, "again " * 35]


@pytest.mark.parametrize(("seed", "window"), [(1, 35), (2, 35), (3, 16)])
def test_cut_words_equal_brute_force(spark, seed, window):
    rows = list(enumerate([*corpus(seed), *ODD_TEXTS, *ODD_TEXTS]))
    assert run(documents(spark, rows).repartition(5), window) == brute(rows, window)


def test_small_vocabulary(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 150, vocabulary=2)) for i in range(40)]
    assert run(documents(spark, rows).repartition(4), 35) == brute(rows, 35)


def test_null_and_repeated_ids(spark):
    rng = random.Random(5)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(None, a), (None, b + " tail"), (3, a), (3, b), (3, "short"), (4, None)]
    assert run(documents(spark, rows), 35) == brute(rows, 35)


def test_texts_keep_their_white_space(spark):
    passage = prose(random.Random(6), 40)
    df = documents(spark, [(1, f"Head\n\nline  two\n{passage}\ttail  end"), (2, passage), (3, "un\n touched ")])
    found = {r.row.doc_id: r.text for r in S.cut(df, S.kept_text, "text", keep=df.columns).collect()}
    assert found == {1: "Head\n\nline  two tail  end", 2: "", 3: "un\n touched "}


def test_empty_table(spark):
    assert run(documents(spark, []), 35) == []
