"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Documents are dealt by a hash of their row to groups of about ``GROUP_ROWS``, and each
group is packed by itself, largest first.  Its open bins are kept in order of the
room left and carry two bitmaps, one of the sources and one of the clusters of copies
that they hold.  A document goes to the successor of its size in that order, and
on to the next until a bin shares no bit with it: the tightest compatible bin.  If
there is none, a bin is opened.  A document longer than a bin is cut: its full
pieces fill bins of their own, the last piece is packed like any other.

Groups are hashed, so neither a hot source nor a large cluster gathers in one; every
task holds one group of narrow rows.  Equal rows are counted before the shuffle and dealt
in runs of ``RUN_ROWS``, each to a group of its own, so neither one id with most of the rows nor
rows without an id make a group large.  Bins never mix groups, which leaves at most
one loose tail of bins in each.

Defined results: a null source is a source of its own; a null or empty text has size 0
and takes a place without room; a very long text is cut into pieces; equal texts are one cluster; rows with the same id
are packed each by itself; equal sizes are packed by ascending id, then cluster and source; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.common import arrow_batches, materialize, n_words

CAPACITY = 2048
GROUP_ROWS = 4096
#: Equal rows that are dealt together.
RUN_ROWS = 64
_SCHEMA = "doc_id long, size long, piece int, pieces int, group_id long, bin long, start long, piece_size long, source string, cluster long"


def pack(items: Iterable[tuple[int, int, int]], capacity: int) -> list[tuple[int, int]]:
    """``(bin, start)`` of each ``(size, source, cluster)``; sizes are at most ``capacity`` and come largest first."""
    order: list[tuple[int, int]] = []  # (room left, bin)
    sources: list[int] = []
    clusters: list[int] = []
    out = []
    for size, source, cluster in items:
        s, c = 1 << source, 1 << cluster
        for at in range(bisect_left(order, (size, -1)), len(order)):
            room, box = order[at]
            if not (sources[box] & s or clusters[box] & c):
                del order[at]
                break
        else:
            room, box = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[box] |= s
        clusters[box] |= c
        insort(order, (room - size, box))
        out.append((box, capacity - room))
    return out


def _pack_group(capacity: int):  # noqa: ANN202
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.loc[rows.index.repeat(rows["copies"])]
        rows = rows.assign(full=rows["size"] // capacity, tail=rows["size"] % capacity)
        whole = (rows["tail"] == 0) & (rows["full"] > 0)
        rows.loc[whole, "full"] -= 1
        rows.loc[whole, "tail"] = capacity
        rows = rows.sort_values(["tail", "doc_id", "cluster", "source"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        source = pd.factorize(rows["source"], use_na_sentinel=False)[0]
        cluster = pd.factorize(rows["cluster"])[0]
        placed = pack(zip(rows["tail"].tolist(), source.tolist(), cluster.tolist(), strict=True), capacity)
        opened = max((b for b, _ in placed), default=-1) + 1
        out = rows.assign(piece=rows["full"], bin=[b for b, _ in placed], start=[s for _, s in placed], piece_size=rows["tail"])
        cut = rows[rows["full"] > 0]
        if len(cut):
            long = cut.loc[cut.index.repeat(cut["full"])]
            piece = long.groupby(level=0).cumcount()
            long = long.assign(piece=piece, bin=range(opened, opened + len(long)), start=0, piece_size=capacity)
            out = pd.concat([out, long])
        out = out.assign(pieces=out["full"] + 1)
        return out[["doc_id", "size", "piece", "pieces", "group_id", "bin", "start", "piece_size", "source", "cluster"]]

    return run


def best_fit(docs: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, key: str = "doc_id", text: str = "text",
             source: str = "source") -> DataFrame:
    """One row for each piece of each document: its bin ``(group_id, bin)`` and where in it the piece starts."""
    arrow_batches(docs.sparkSession)
    rows = materialize(docs.select(
        F.col(key).alias("doc_id"), n_words(F.col(text)).alias("size"), F.col(source).alias("source"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("cluster")), "pack-rows")
    groups = max(1, -(-rows.count() // group_rows))
    counted = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("rows"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(RUN_ROWS).cast("long"))))
    dealt = runs.select(*rows.columns, F.least(F.col("rows") - F.col("run"), F.lit(RUN_ROWS)).alias("copies"),
                        F.pmod(F.xxhash64(*rows.columns, "run"), F.lit(groups)).alias("group_id"))
    return dealt.groupBy("group_id").applyInPandas(_pack_group(capacity), _SCHEMA)
