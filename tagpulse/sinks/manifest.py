"""Numbered manifests: small JSON files that say which folders make up a table.

A manifest is written beside its final name and moved there in one step, which fails if the number is taken.
Readers take the newest, so they see all of a change or nothing of it, and a run that dies before the move has changed nothing.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession

FOLDER = "_manifests"


def _paths(spark: SparkSession, path: str):  # noqa: ANN202
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(f"{path}/{FOLDER}")
    return hadoop, root, root.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    _, root, fs = _paths(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, dict[str, Any]] | None:
    """The newest (or a given) manifest and its number."""
    if version is None:
        found = versions(spark, path)
        if not found:
            return None
        version = found[-1]
    hadoop, root, fs = _paths(spark, path)
    stream = fs.open(hadoop.Path(root, f"{version:010d}.json"))
    try:
        body = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return version, json.loads(body)


def commit(spark: SparkSession, path: str, version: int, body: dict[str, Any]) -> None:
    """Make ``body`` the manifest ``version``; an error if another writer has made that one."""
    hadoop, root, fs = _paths(spark, path)
    final = hadoop.Path(root, f"{version:010d}.json")
    draft = hadoop.Path(root, f".{version}-{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(bytearray(json.dumps(body).encode()))
    finally:
        out.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)
    except Exception:
        fs.delete(draft, False)
        raise


def forget(spark: SparkSession, path: str, keep: int) -> list[dict[str, Any]]:
    """Delete all but the last ``keep`` manifests; returns what the deleted ones said."""
    hadoop, root, fs = _paths(spark, path)
    gone = []
    for version in versions(spark, path)[:-keep]:
        gone.append(read(spark, path, version)[1])
        fs.delete(hadoop.Path(root, f"{version:010d}.json"), False)
    return gone
