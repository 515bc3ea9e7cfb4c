import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagpulse.llm import common as C


def components_of(edges):
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize("shape", ["chain", "star", "random"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {"chain": [(i, i + 1) for i in range(60)][::-1], "star": [(500, i) for i in range(200)],
             "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]}[shape]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in C.components(df).collect()}
    want = components_of([e for e in edges if e[0] != e[1]])
    assert found == want


def test_components_of_nothing(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_look_up_takes_heavy_and_light_keys(spark, monkeypatch):
    monkeypatch.setattr(C, "HEAVY", 4)
    rows = spark.createDataFrame([(i, "hot" if i < 60 else f"k{i % 7}") for i in range(100)], "i long, k string")
    found = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("least")).where("n > 5")
    got = sorted(map(tuple, C.look_up(rows, found, ["k"], "n", 100).select("i", "least").collect()))
    least = {r.k: r.least for r in found.collect()}
    assert got == sorted((r.i, least[r.k]) for r in rows.collect() if r.k in least)


def test_ordered_buckets(spark, monkeypatch):
    monkeypatch.setattr(C, "ROWS_PER_BUCKET", 10)
    rng = random.Random(2)
    ids = [rng.randrange(-1000, 1000) for _ in range(500)]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,)], "id long")
    bounds = C.order_bounds(df, "id")
    assert len(bounds) > 20 and bounds == sorted(bounds)
    for r in df.withColumn("b", C.bucket_of(F.col("id"), bounds)).collect():
        assert r.b == (0 if r.id is None else sum(x <= r.id for x in bounds))
    assert C.order_bounds(df.limit(0), "id") == []


@pytest.mark.parametrize("kind", [np.int64, np.uint8])
def test_counters_add_up_and_stop_at_their_largest_value(spark, kind):
    def run(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                counts = np.zeros(1000, kind)
                counts[i] = 100
                counts[7] = 90
                rows = list(C.counter_rows(counts, kind))
                yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["block", "counts"])

    C.arrow_batches(spark)
    total = C.sum_counters(spark.range(5).mapInArrow(run, "block int, counts binary"), (1000,), kind)
    assert total[0] == 100 and total[7] == (450 if kind is np.int64 else 255) and total.sum() == 500 + int(total[7])
    assert total.dtype == kind


def test_words_are_counted(spark):
    df = spark.createDataFrame([("a  b\tc\x0bd\x0ce\r\nf",), ("",), (None,), (" \n",), ("é ü",)], "t string")
    assert [r.n for r in df.select(C.n_words(F.col("t")).alias("n")).collect()] == [6, 0, 0, 0, 2]
