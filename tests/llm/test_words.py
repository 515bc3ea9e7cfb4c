import random

import numpy as np
import pyarrow as pa

from tagpulse.llm import words as W
from tagpulse.llm.substring import sliding_argmin
from tests.llm.helpers import ODD_TEXTS, words


def test_words_and_hashes_do_not_depend_on_position():
    texts = [*ODD_TEXTS, "x\x0by\x0cz", "Ab aB ab", "ab"]
    seen = {}
    for size in (8, 100, 1 << 20):
        for c in W.chunks(pa.array(texts), size):
            split = W.split_words(c)
            for r, (a, b) in enumerate(zip(split.first[:-1], split.first[1:])):
                found = [c.text(x, y).decode() for x, y in zip(split.starts[a:b], split.ends[a:b])]
                assert found == words(texts[c.lo + r])
                for w, h in zip(found, split.hashes[a:b].tolist()):
                    assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_lower_case_is_ascii_only():
    (c,) = W.chunks(pa.array(["ABC abc Äb äb"]))
    h = W.split_words(c, lower=True).hashes.tolist()
    assert h[0] == h[1] and h[2] != h[3]


def test_pieces_join_to_the_text():
    texts = ["a  b.\nc", " lead, it's (x)", "tail \n ", "", "é.é a.b"]
    for c in W.chunks(pa.array(texts)):
        p = W.split_pieces(c)
        for r, (a, b) in enumerate(zip(p.first[:-1], p.first[1:])):
            assert "".join(c.text(x, y).decode() for x, y in zip(p.starts[a:b], p.ends[a:b])) == texts[c.lo + r]


def test_windows_and_sliding_minima():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 5, 200).astype(np.uint64)
    for k in (1, 3, 16, 25):
        found = W.window_hashes(h, k).tolist()
        same = {}
        for i, x in enumerate(found):
            assert same.setdefault(tuple(h[i:i + k].tolist()), x) == x
        assert len(set(found)) == len(same)
        assert W.sliding_min(h, k).tolist() == [min(h[i:i + k]) for i in range(len(h) - k + 1)]
        assert sliding_argmin(h, k).tolist() == [i + int(np.argmin(h[i:i + k])) for i in range(len(h) - k + 1)]


def test_text_longer_than_a_chunk():
    rng = random.Random(2)
    text = " ".join(rng.choice(["ab", "cd", "ef"]) for _ in range(50_000))
    (c,) = W.chunks(pa.array([text]), 1000)
    assert len(W.split_words(c).hashes) == 50_000


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_repetitive_words_and_sequences_keep_their_own_hashes():
    """Runs in the order of Thue and Morse and their complements share every polynomial hash modulo a power of two."""
    for n in (8, 64, 1024, 2048):
        letters = ["".join("ab"[b ^ flip] for b in thue_morse(n)) for flip in (0, 1)]
        sequences = [" ".join(("left", "right")[b ^ flip] for b in thue_morse(n)) for flip in (0, 1)]
        (c,) = W.chunks(pa.array([*letters, *sequences]))
        w = W.split_words(c)
        assert w.hashes[0] != w.hashes[1]
        spans = W.span_hashes(w.hashes, w.first[:-1], w.first[1:])
        assert len(set(spans.tolist())) == 4
        p = W.split_pieces(c)
        assert p.hashes[p.first[0]] != p.hashes[p.first[1]]


def test_span_hashes_equal_the_polynomial():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    prime = (1 << 61) - 1
    a = rng.integers(0, 300, 50)
    b = np.minimum(300, a + rng.integers(0, 200, 50))
    found = W._ranges(h, a, b).tolist()
    for x, y, got in zip(a.tolist(), b.tolist(), found):
        assert got % prime == sum(int(v) % prime * pow(W._BASE, i, prime) for i, v in enumerate(h[x:y])) % prime
