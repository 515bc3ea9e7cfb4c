import hashlib
import random
import re

import pytest

from tagpulse.llm import common
from tagpulse.llm import spotsigs as S
from tests.llm.helpers import ODD_TEXTS, documents


def signature_set(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    content = [x for x in w if x not in S.ANCHORS]
    spots, before = [], 0
    for x in w:
        if x in S.ANCHORS:
            spots.append((x, *content[before:before + S.CHAIN]))
        else:
            before += 1
    if not spots:
        spots = [tuple(content[i:i + S.CHAIN]) for i in range(len(content))] or ([text] if text else [])
    return set(spots)


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus(seed, n=60):
    rng = random.Random(seed)
    pool = [*S.ANCHORS[:12], *[f"word{i}" for i in range(40)]]
    texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(1, 80))) for _ in range(n)]
    for t in texts[:15]:
        w = t.split()
        w[rng.randrange(len(w))] = "edit"
        texts += [t, " ".join(w)]
    return texts + ODD_TEXTS + ["!!!", "the of the", "Kein Anker hier"]


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (d, t) in enumerate(order):
        text, following = t or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        out[d] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), likeness(signature_set(text), signature_set(edited)),
                  likeness(signature_set(text), signature_set(following)))
    return out


@pytest.mark.parametrize("bucket", [4, 512])
def test_fingerprints_equal_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", bucket)
    texts = corpus(1)
    rows = [(i * 5 - 40, t) for i, t in enumerate(texts)] + [(None, "the only one without an id")]
    found = S.fingerprints(documents(spark, rows).repartition(4)).collect()
    want = expected(rows)
    assert len(found) == len(rows)
    for r in found:
        n, sha, edited, following = want[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert r.near_edited == pytest.approx(edited) and r.near_next == pytest.approx(following)
    text = dict(rows)
    by_text = {}
    for r in found:
        assert by_text.setdefault(text[r.doc_id] or "", r.fingerprint) == r.fingerprint


def test_one_row_and_none(spark):
    (r,) = S.fingerprints(documents(spark, [(1, "the cat sat down")])).collect()
    assert r.near_next == 1.0 and r.n_chars == 16
    assert S.fingerprints(documents(spark, [])).count() == 0


def test_repeated_ids_keep_their_rows(spark):
    found = S.fingerprints(documents(spark, [(1, "the cat sat"), (1, "the cat sat"), (1, "of mice")])).collect()
    assert len(found) == 3


def test_code_points(spark):
    (a, b) = sorted(S.fingerprints(documents(spark, [(2, "😀é"), (1, "日本語")])).collect(), key=lambda r: -r.doc_id)
    assert a.n_chars == 2 and a.edited_sha256 == hashlib.sha256("😀日".encode()).hexdigest()
    assert b.n_chars == 3 and b.edited_sha256 == hashlib.sha256("日本😀".encode()).hexdigest()


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_near_pairs_equal_brute_force(spark, threshold):
    rows = list(enumerate(corpus(2, 40)))
    pairs, members = S.near_pairs(documents(spark, rows), threshold)
    classes = {}
    sets = {d: frozenset(signature_set(t)) for d, t in rows}
    for d, s in sorted(sets.items()):
        classes.setdefault(s, d)
    assert {r.doc_id: r.class_id for r in members.collect()} == {d: classes[s] for d, s in sets.items()}
    reps = sorted((d, s) for s, d in classes.items() if s)
    want = {(a, b) for i, (a, x) in enumerate(reps) for b, y in reps[i + 1:] if likeness(x, y) >= threshold}
    assert {(r.a, r.b) for r in pairs.collect()} == want
