"""A view with one row per key that takes upserts.

The original saves documents by ``_id``.  Here a view is a table of two parts:

* ``base/version=V/bucket=B``: rows hashed by key, one for each key.  A manifest says which version of each bucket counts;
* ``delta/batch_id=N``: what a batch wrote.  A batch that runs again overwrites its own folder.

``read`` lays the batches that no merge has taken yet over the base: of a key's rows the latest batch counts (or the smallest
row, ``prefer="smallest"``).  Base rows are unique already, so only the batches' keys are grouped, and a base row
is dropped by an anti join with them; a filter on a column reaches the base's scan.

``merge`` rewrites the buckets that batches have touched, and no other: untouched files stay where they are and keep their names.
Files of the manifest before stay until the next merge, so a running reader keeps its files.  When buckets have grown beyond
``bucket_bytes`` on average, a merge doubles their number and rewrites all, which a key pays for a logarithmic number of times.
One writer merges at a time; a second one fails at the commit.

A null key takes no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tagpulse.session import TEXT_ROWS, delete_path, folder_bytes, split_repeated
from tagpulse.sinks import manifest
from tagpulse.sinks.writers import _numbered

LATEST, SMALLEST = "latest", "smallest"
BUCKETS, BUCKET_BYTES = 16, 256 << 20


@dataclass(frozen=True)
class KeyedView:
    spark: SparkSession
    path: str
    schema: StructType
    key: str = "_id"
    prefer: str = LATEST
    buckets: int = BUCKETS
    bucket_bytes: int = BUCKET_BYTES

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(n)).cast("int")

    def _state(self) -> tuple[int, dict]:
        """The newest manifest: ``buckets``, ``folders`` (bucket: version) and ``upto``, the last batch merged."""
        return manifest.read(self.spark, self.path) or (-1, {"buckets": self.buckets, "folders": {}, "upto": -1})

    def _read(self, folders: list[str], base: str, *columns: StructField) -> DataFrame:
        schema = StructType([*self.schema.fields, *columns])
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", base).parquet(*folders)

    def batches(self, last: int | None = None) -> list[int]:
        """Completely written batches (none after ``last``) that no merge has taken."""
        upto = self._state()[1]["upto"]
        return sorted(n for n, complete in _numbered(self.spark, f"{self.path}/delta", "batch_id").items()
                      if complete and n > upto and (last is None or n <= last))

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        """The rows of a batch; written again, the batch replaces itself.  Batches count in the order of their numbers."""
        rows = rows.where(F.col(self.key).isNotNull()).select(*self.schema.names)
        rows.write.mode("overwrite").options(**(TEXT_ROWS if self.prefer == SMALLEST else {})).parquet(f"{self.path}/delta/batch_id={batch_id}")

    def _base(self, state: dict, buckets: list[str] | None = None) -> DataFrame:
        wanted = state["folders"] if buckets is None else {b: v for b, v in state["folders"].items() if b in buckets}
        folders = [f"{self.path}/base/version={v}/bucket={b}" for b, v in sorted(wanted.items(), key=lambda x: int(x[0]))]
        return self._read(folders, f"{self.path}/base", StructField("version", IntegerType()), StructField("bucket", IntegerType())).select(*self.schema.names)

    def _delta(self, batches: list[int]) -> DataFrame:
        folders = [f"{self.path}/delta/batch_id={b}" for b in batches]
        return self._read(folders, f"{self.path}/delta", StructField("batch_id", LongType()))

    def _one_each(self, rows: DataFrame) -> DataFrame:
        """One row of each key; pre-aggregated, so a key that a batch repeats is sent once."""
        values = [F.col(c) for c in self.schema.names if c != self.key]
        # Of rows of one batch the smallest: an order of its own, not that of the files.
        order = [(-F.col("batch_id")).alias("behind"), *values] if self.prefer == LATEST else values
        if self.prefer == SMALLEST:
            # Such rows hold texts: only those of a key that comes again are moved.  The keys are counted first.
            once, rows = split_repeated(rows.select(*self.schema.names), self.key)
        first = rows.groupBy(self.key).agg(F.min(F.struct(*order)).alias("r"))
        first = first.select(*[F.col(c) if c == self.key else F.col(f"r.`{c}`").alias(c) for c in self.schema.names])
        return once.unionByName(first) if self.prefer == SMALLEST else first

    def _overlaid(self, base: DataFrame, delta: DataFrame) -> DataFrame:
        if self.prefer == LATEST:
            new = self._one_each(delta)
            return base.join(new.select(self.key), self.key, "left_anti").select(*self.schema.names).unionByName(new)
        # The smallest of all rows of a key: base rows of other keys pass without being grouped.
        if not self._state()[1]["folders"]:
            return self._one_each(delta.select(*self.schema.names))
        keys = delta.select(self.key).distinct()
        same = base.join(keys, self.key, "left_semi").select(*self.schema.names)
        return base.join(keys, self.key, "left_anti").select(*self.schema.names).unionByName(self._one_each(delta.select(*self.schema.names).unionByName(same)))

    def read(self, where: Column | None = None, last: int | None = None) -> DataFrame:
        """One row per key, from batches up to ``last``; ``where`` is a condition on other columns than the key."""
        state = self._state()[1]
        base, batches = self._base(state), self.batches(last)
        if not batches:
            return base if where is None else base.where(where)
        if where is None or self.prefer != LATEST:
            out = self._overlaid(base, self._delta(batches))
            return out if where is None else out.where(where)
        # Of the batches the condition is asked of the row that counts; of the base, at the scan.
        return self._overlaid(base.where(where), self._delta(batches)).where(where)

    def merge(self, last: int | None = None) -> int | None:
        """Take all complete batches (up to ``last``) into the base; returns the last one taken so far."""
        version, state = self._state()
        batches = self.batches(last)
        if batches:
            n, made = state["buckets"], version + 1
            size = sum(folder_bytes(self.spark, f"{self.path}/base/version={v}/bucket={b}") for b, v in state["folders"].items())
            if size > n * self.bucket_bytes:
                n, touched = 2 * n, None
            else:
                touched = [str(r["bucket"]) for r in self._delta(batches).select(self._bucket(n).alias("bucket")).distinct().collect()]
            rows = self._overlaid(self._base(state, touched), self._delta(batches)).withColumn("bucket", self._bucket(n))
            # A folder that a run left behind before its commit is no manifest's: it is overwritten.
            rows.repartition("bucket").sortWithinPartitions("bucket", *[c for c in self.schema.names if c != self.key][:1], self.key) \
                .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/base/version={made}")
            written = [str(b) for b in _numbered(self.spark, f"{self.path}/base/version={made}", "bucket")]
            kept = {} if touched is None else {b: v for b, v in state["folders"].items() if b not in touched}
            state = {"buckets": n, "folders": {**kept, **{b: made for b in written}}, "upto": batches[-1]}
            manifest.commit(self.spark, self.path, made, state)
            self._tidy(state)
        return state["upto"] if state["upto"] >= 0 else None

    def _tidy(self, state: dict) -> None:
        """Delete what only manifests before the last two name, and the batches that the one before the last had taken."""
        gone = manifest.forget(self.spark, self.path, keep=2)
        kept = [manifest.read(self.spark, self.path, v)[1] for v in manifest.versions(self.spark, self.path)]
        used = {(b, v) for s in kept for b, v in s["folders"].items()}
        for b, v in {(b, v) for s in gone for b, v in s["folders"].items()} - used:
            delete_path(self.spark, f"{self.path}/base/version={v}/bucket={b}")
        upto = min((s["upto"] for s in kept), default=-1) if len(kept) > 1 else -1
        for b in _numbered(self.spark, f"{self.path}/delta", "batch_id"):
            if b <= upto:
                delete_path(self.spark, f"{self.path}/delta/batch_id={b}")
