"""The registered queries with SQL against DuckDB, and the pipeline against brute force."""

import random

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tagpulse.llm import queries as Q
from tests.llm.helpers import documents, prose, words, write
from tests.llm.test_ngram_join import brute as joined
from tests.llm.test_substring import brute as cut
from tools.compare import frame_digest


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_query_matches_oracle(spark, sf_small, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    df = Q.QUERIES[name](spark, sf_small)
    res = con.execute(Q.ORACLE_SQL[name])
    columns, rows = [d[0] for d in res.description], res.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert frame_digest(df.columns, [tuple(r) for r in df.collect()]) == frame_digest(columns, rows)


def test_every_operator_is_registered():
    names = set(E.queries())
    assert {n.split("_")[0] for n in Q.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert {*Q.QUERIES, "pipeline"} <= names
    assert set(Q.ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for table in ("documents", "labels", "pages", "embeddings", "benchmark"):
        write(spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(0), tmp_path, table)
    assert Q.QUERIES[name](spark, str(tmp_path)).count() == 0


def corpus():
    rng = random.Random(1)
    slurs = ["vilmo", "grotch", "spunder"]
    rows, marks = [], []
    for i in range(300):
        w = [f"w{int(rng.paretovariate(0.7)) % 900}" for _ in range(rng.randrange(40, 120))]
        if i % 6 == 0:
            w[5:5] = [rng.choice(slurs) for _ in range(5)]
        rows.append([i, " ".join(w), rng.choice(["a", "b", None])])
        marks.append((i, 0, int(i % 6 == 0)))
    passage = prose(rng, 60)
    for i in (1, 7, 13, 19):
        rows[i][1] += " " + passage
    for i in range(40):
        w = rows[2 + 6 * (i % 5)][1].split()
        w[rng.randrange(len(w))] = "edit"
        rows.append([300 + i, " ".join(w) if i % 2 else rows[2][1], "b"])
        marks.append((300 + i, 0, 0))
    rows += [[400, None, "a"], [401, "", None], [None, "a text without id", "a"]]
    return [tuple(r) for r in rows], marks


def test_pipeline_stages_on_planted_cases(spark, tmp_path):
    rows, marks = corpus()
    write(documents(spark, rows).select("doc_id", "text", "lang", "source", "n_chars"), tmp_path, "documents")
    write(spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), tmp_path, "labels")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = P.materialize(stage(spark, docs, str(tmp_path)), name)
        seen[name] = docs.collect()
        if name != "packing":
            assert docs.columns == columns
    text = {r[0]: r[1] for r in rows}
    toxic = {m[0] for m in marks if m[2]}
    clean = {r.doc_id for r in seen["toxicity"]}
    assert not clean & toxic and clean == set(text) - toxic

    left = [(r.doc_id, r.text) for r in seen["toxicity"]]
    kept = {d for d, _, c in joined(left, P.SHINGLE_WORDS, P.LIKENESS_PERCENT) if c == d}
    assert {r.doc_id for r in seen["near_duplicates"]} == kept

    left = [(r.doc_id, r.text) for r in seen["near_duplicates"]]
    import hashlib
    want = {d: (n - gone, sha) for d, n, gone, sha in cut(left, 35)}
    assert any(gone for *_, gone, _ in cut(left, 35))
    for r in seen["substring_dedup"]:
        w = words(r.text)
        assert (len(w), hashlib.sha256(" ".join(w).encode()).hexdigest()) == want[r.doc_id]
        assert (r.text is None) == (text[r.doc_id] is None)
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert len(seen["substring_dedup"]) == len(left)

    took = {}
    for r in seen["mixing"]:
        took[r.doc_id] = took.get(r.doc_id, 0) + 1
    assert max(took.values()) <= 3
    packed = {}
    for r in seen["packing"]:
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.piece_size
    size = {r.doc_id: len(words(r.text)) for r in seen["substring_dedup"]}
    assert packed == {d: n * size[d] for d, n in took.items()}


def test_run_returns_the_last_stage(spark):
    found = P.run(spark, "/root/testdata/sf0.001")
    assert found.count() > 0 and "bin" in found.columns
