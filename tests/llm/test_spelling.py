import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagpulse.llm import spelling as S
from tests.llm.helpers import ODD_TEXTS, documents

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(x, y):
    if len(x) < len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(x) == len(y) + 1 and any(x[:i] + x[i + 1:] == y for i in range(len(x)))


def counted(rows):
    n = Counter()
    for d, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute(rows):
    n = counted(rows)
    form, near = {}, {}
    for w in n:
        near[w] = [x for x in n if x != w and abs(len(x) - len(w)) < 2 and one_edit(x, w)]
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def corpus(seed=1, size=1400):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randrange(3, 9))) for _ in range(60)]
    stems += ["sharedbeginning" + "".join(rng.choice("xyz") for _ in range(4)) for _ in range(40)]
    stems += ["".join(rng.choice("xyz") for _ in range(4)) + "sharedending" for _ in range(40)]
    rows = []
    for i in range(size):
        w = []
        for _ in range(rng.randrange(30)):
            s = rng.choice(stems[: 1 + int(rng.paretovariate(0.5)) % len(stems)])
            if rng.random() < 0.3:
                k = rng.randrange(len(s))
                s = s[:k] + rng.choice(["", "a", "b", "é", s[k] * 2]) + s[k + 1:]
            w.append(s.upper() if rng.random() < 0.1 else s)
        rows.append((i, " ".join(w) if i % 3 else "-".join(w) + "9÷×ß"))
    return rows + [(5000 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(0, "again again again"), (None, "aaaaa aaaaa aaaaa bbbbb")]


@pytest.mark.parametrize("largest", [S.LARGEST, 12, 2])
def test_equals_brute_force(spark, largest):
    rows = corpus()
    got = sorted(map(tuple, S.variants(documents(spark, rows).repartition(5), largest=largest).select("word", "form", "root", "n", "n_near", "form_n").collect()))
    want = brute(rows)
    assert got == want
    assert len(want) > 300 and sum(w[1] is not None for w in want) > 100


def test_checksums_equal_zlib():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcÄ") for _ in range(rng.randrange(1, 100))).encode() for _ in range(200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    before = np.array([zlib.crc32(f"{i}:".encode()) for i in range(200)], np.uint32)
    got = S.checksums(data, ends - [len(t) for t in texts], ends, before)
    assert got.tolist() == [zlib.crc32(f"{i}:".encode() + t) for i, t in enumerate(texts)]


def test_partitions_stay_small_and_lose_no_pair(spark):
    """A third of all words share their beginning."""
    rng = random.Random(6)
    words = {"prefixes" + "".join(rng.choice("abcd") for _ in range(rng.randrange(4, 7))) for _ in range(1500)}
    words |= {"".join(rng.choice("abcd") for _ in range(rng.randrange(5, 9))) for _ in range(1500)}
    table = spark.createDataFrame([(w, 3) for w in sorted(words)], "word string, n long")
    rows = S.partitions(table, largest=60)
    sizes = rows.groupBy("key").count()
    left = F.expr("int(split(key, ' ')[0]) - int(split(key, ' ')[1]) - int(split(key, ' ')[2])")
    assert sizes.where(left > 2).agg(F.max("count")).first()[0] <= 60
    got = {r["word"]: r["n_near"] for r in S.near(rows).groupBy("word").agg(F.sum("n_near").alias("n_near")).collect()}
    want = Counter()
    for w in words:
        for i in range(len(w) + 1):
            for c in "abcdefghijklmnopqrstuvwxyz":
                for x in {w[:i] + c + w[i:], w[:i] + c + w[i + 1:] if i < len(w) else w}:
                    if x in words and x != w:
                        want[w, x] = want[x, w] = 1
    per_word = Counter(w for w, _ in want)
    assert got == dict(per_word)


def test_equal_right_languages_are_one_state():
    a = S.Acceptor()
    root = a.state(sorted(["cars", "cats", "bars", "bats"]))
    assert len(a.arcs) == 5 and sorted(a.accepted(root)) == ["bars", "bats", "cars", "cats"]


def test_roots_follow_long_chains(spark):
    chain = [(f"w{i:03d}", f"w{i + 1:03d}") for i in range(37)]
    got = dict(map(tuple, S.roots(spark.createDataFrame(chain, "word string, form string")).collect()))
    assert got == {f"w{i:03d}": "w037" for i in range(37)}
