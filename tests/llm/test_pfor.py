import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagpulse.llm import pfor as P
from tagpulse.llm.words import chunks
from tagpulse.session import scratch_path
from tests.llm.helpers import ODD_TEXTS, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), max_size=700), st.sampled_from([8, 64, 256]), st.sampled_from([0.0, 0.5, 0.9, 1.0]))
def test_round_trip(values, block, percentile):
    values = np.array(values, np.uint32)
    reader = P.Reader(P.encode(values, block, percentile))
    assert (reader.decode() == values).all()
    parts = [reader.decode_block(i) for i in range(len(reader))]
    assert (np.concatenate(parts) == values).all() if parts else not len(values)


def test_outliers_go_to_the_exception_list():
    values = np.full(256, 7, np.uint32)
    values[[3, 200]] = 40_000
    reader = P.Reader(P.encode(values))
    assert reader.width.tolist() == [0] and reader.where.tolist() == [3, 200]


def test_not_a_block_file():
    with pytest.raises(ValueError):
        P.Reader(b"\0" * 64)


TEXTS = [*ODD_TEXTS, "a   b  c", "x<|endoftext|> y <|endoftext|>", " \n\n lead  trail \n ", "tab\tx\r\ny don't we'll I'M", "a\x1c b\x85c",
         "　 　x  y", "a.b, (c) 'd' --e 12.5% 3rd é.é é! …. €.", "日本語 テキスト 😀!", "\n\nA\n\n\nB", "it's.'s 's", "<|endof text|>"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab Z'1.!é\n\t  ,-s<|>"), max_size=30), min_size=1, max_size=5))
def test_pieces_give_the_librarys_ids(texts):
    check_ids(texts)


def check_ids(texts):
    library, own = Tokenizer.from_file(PATH), P.encoder(PATH)
    for chunk in chunks(pa.array(texts)):
        ids, sizes = own.encode(chunk, 2)
        expected = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts[chunk.lo:chunk.hi]]
        assert ids.tolist() == sum(expected, [])
        assert sizes.tolist() == [len(e) for e in expected]


def test_odd_texts_give_the_librarys_ids():
    check_ids(TEXTS)


def test_forgetting_pieces_changes_nothing():
    own = P.PieceEncoder(PATH, limit=3)
    (chunk,) = chunks(pa.array(["one two three four five", "one six"]))
    again = P.encoder(PATH).encode(chunk, 2)[0].tolist()
    assert own.encode(chunk, 2)[0].tolist() == again == own.encode(chunk, 2)[0].tolist()


@pytest.mark.parametrize("segment_ids", [1, 500, 1 << 20])
def test_written_tables_read_back(spark, monkeypatch, segment_ids):
    from tagpulse.llm import common
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", 16)
    texts = TEXTS * 4 + [f"text number {i}" for i in range(40)]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (6, "again"), (6, "Again")]
    path = scratch_path(spark, "ids")
    P.write_ids(documents(spark, rows).repartition(5), path, PATH, segment_ids=segment_ids)
    found = P.read_checksums(spark, path).collect()
    library, at = Tokenizer.from_file(PATH), 0
    expected = []
    for d, t in sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        expected.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    whole = P.read_ids(spark, path).collect()
    assert {(r.start, zlib.crc32(bytes(r.ids))) for r in whole} == {(e[1], e[3]) for e in expected}


def test_empty_table(spark):
    path = scratch_path(spark, "ids")
    P.write_ids(documents(spark, []), path, PATH)
    assert P.read_checksums(spark, path).count() == 0
