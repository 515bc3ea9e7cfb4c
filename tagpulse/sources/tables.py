"""The driver-provided parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; callers select only the columns they need so that the
    ``ReadSchema`` of the scan is pruned by Catalyst."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition ``df`` on ``keys`` only when its scan has fewer splits
    than the cluster has cores (a small, single-split file feeding CPU-heavy
    text work).  Large inputs keep their file splits: no extra shuffle.
    Call on a plain scan/projection (no joins), where counting splits does
    not run a job."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)
