import random

import numpy as np
import pyarrow as pa

from tagpulse.llm import tokens as T
from tagpulse.llm.words import IS_SPACE, run_hashes
from tests.llm.helpers import ODD_TEXTS, words


def hashed(texts):
    data, rows = T.text_bytes(pa.array(texts, pa.string()))
    starts, ends, first = T.runs(~IS_SPACE[data], rows)
    return run_hashes(data, starts, ends), first


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_runs_and_hashes_follow_the_words():
    rng = random.Random(2)
    texts = [*ODD_TEXTS, *("".join(rng.choice("ab \tÄ\x0b") for _ in range(rng.randrange(60))) for _ in range(300)), "x" * 200, "x" * 201]
    hashes, first = hashed(texts)
    flat = [w for t in texts for w in words(t)]
    assert np.diff(first).tolist() == [len(words(t)) for t in texts] and len(hashes) == len(flat)
    by_word = {}
    for w, h in zip(flat, hashes.tolist()):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_no_structural_collision():
    for n in (8, 16, 64, 1024, 2048):
        a = "".join("ab"[b] for b in thue_morse(n))
        b = "".join("ba"[b] for b in thue_morse(n))
        hashes, _ = hashed([a, b])
        assert hashes[0] != hashes[1]


def test_packing_round_trips():
    rng = np.random.default_rng(1)
    for values in (np.empty(0, np.uint64), np.array([0], np.uint64), np.array([2**64 - 1, 0, 5], np.uint64), rng.integers(0, 300, 1000).astype(np.uint64)):
        assert np.array_equal(T.unpack(T.pack(values)), values)
        assert np.array_equal(T.unpack_sorted(T.pack_sorted(np.sort(values))), np.sort(values))


def test_batches_are_gathered_and_cut_by_bytes():
    texts = ["a" * n for n in (5, 0, 30, 2, 2, 2, 2, 9)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts, pa.string())], ["i", "t"])
    for pieces in ([batch], [batch.slice(i, 1) for i in range(9)], [batch.slice(0, 0), batch.slice(0, 4), batch.slice(4)]):
        out = list(T.gathered(iter(pieces), 10, 1))
        assert sum((b.column(1).to_pylist() for b in out), []) == texts
        assert all(b.num_rows == 1 or sum(len(t or "") for t in b.column(1).to_pylist()) <= 10 for b in out)
        assert len(out) <= 5
