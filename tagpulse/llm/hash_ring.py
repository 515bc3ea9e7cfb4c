"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points (virtual nodes) of the 64-bit ring; a document
lies at the hash of its id and belongs to the next point clockwise.  A shard
takes at most its capacity: documents that find it full continue clockwise to
the next point whose shard has room.  With capacities that sum to the number of
documents, counts differ by one at most; as only overflow leaves its own arc,
adding a shard or documents moves few of the others.

DataFrame operations only.  What grows with the input is one narrow row per
document; the ring, the counts of the arcs and the flow
between them have a fixed size (shards x virtual nodes) and are settled on the
driver.  Rows that are equal in id, size and checksum are counted before the shuffle and go on in runs of
``RUN_ROWS``; an arc of more than ``PIECE_ROWS`` rows is ranked in pieces by a hash of the run, so an id
(or none) that holds most of the rows makes no window large.

Defined results: a null id is an id of its own; rows with the same id lie at the
same point and are told apart by text checksum and size, or interchangeable; a null text has
size 1 and the checksum of no bytes; a very long text counts all its bytes; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.common import bucket_of

VIRTUAL_NODES = 128
LAW = "rows"
#: Equal rows that are ranked together, and rows of an arc from which it is ranked in pieces.
RUN_ROWS = 1024
PIECE_ROWS = 1 << 18


def ring(spark: SparkSession, shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """``(position, shard)`` of every virtual node, clockwise; the same for every run."""
    nodes = spark.range(shards * virtual_nodes).select(
        F.xxhash64(F.lit("virtual node"), F.col("id") % virtual_nodes, F.floor(F.col("id") / virtual_nodes)).alias("at"),
        F.floor(F.col("id") / virtual_nodes).cast("int").alias("shard"))
    return sorted((r["at"], r["shard"]) for r in nodes.collect())


def capacities(total: int, shards: int) -> list[int]:
    """Equal shares; the first shards take what is left over."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def flow(owners: list[int], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of which arc go where: ``(arc, from_rank, to_rank, shard, first_slot)``.

    All arcs first fill their own shard, in ring order; what is left of an arc then
    asks the owners of the arcs one, two, ... steps further clockwise.  Every
    entry empties its arc or fills its shard, so there are at most arcs + shards."""
    arcs, room, used = len(owners), list(room), [0] * len(room)
    taken, out, waiting = dict.fromkeys(counts, 0), [], sorted(counts)
    for step in range(arcs):
        left = []
        for arc in waiting:
            shard = owners[(arc + step) % arcs]
            n = min(counts[arc] - taken[arc], room[shard])
            if n:
                out.append((arc, taken[arc], taken[arc] + n - 1, shard, used[shard]))
                taken[arc] += n
                room[shard] -= n
                used[shard] += n
            if taken[arc] < counts[arc]:
                left.append(arc)
        waiting = left
        if not waiting:
            break
    return out


def assign(docs: DataFrame, shards: int, virtual_nodes: int = VIRTUAL_NODES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document."""
    spark = docs.sparkSession
    points = ring(spark, shards, virtual_nodes)
    bytes_ = F.coalesce(F.encode(F.col(text), "UTF-8"), F.lit(b""))
    rows = docs.select(
        F.col(key).alias("doc_id"), (F.length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"),
        F.xxhash64(F.col(key)).alias("at"))
    arc = (bucket_of(F.col("at"), [p for p, _ in points]) % len(points)).cast("int")
    counts = {r["arc"]: r["count"] for r in docs.select(F.xxhash64(F.col(key)).alias("at")).groupBy(arc.alias("arc")).count().collect()}
    ranges = flow([s for _, s in points], counts, capacities(sum(counts.values()), shards))
    where = spark.createDataFrame(ranges, "arc int, first long, last long, shard int, slot long")
    cut = spark.createDataFrame([(a, -(-n // PIECE_ROWS)) for a, n in counts.items()], "arc int, pieces long")

    counted = rows.groupBy("doc_id", "size", "text_crc32", "at").agg(F.count(F.lit(1)).alias("rows"))
    runs = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(RUN_ROWS).cast("long"))))
    piece = F.pmod(F.xxhash64("doc_id", "size", "text_crc32", "run"), F.col("pieces"))
    dealt = (runs.withColumn("n", F.least(F.col("rows") - F.col("run"), F.lit(RUN_ROWS))).withColumn("arc", arc)
             .join(F.broadcast(cut), "arc").withColumn("piece", piece).drop("rows", "pieces"))
    within = Window.partitionBy("arc", "piece").orderBy("at", "doc_id", "text_crc32", "size", "run").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("arc").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("arc", "piece").agg(F.sum("n").alias("n")).select("arc", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    ranked = dealt.withColumn("rank", F.coalesce(F.sum("n").over(within), F.lit(0))).join(offsets, ["arc", "piece"])
    at = F.col("offset") + F.col("rank")
    each = ranked.withColumn("rank", F.explode(F.sequence(at, at + F.col("n") - 1)))
    return each.join(F.broadcast(where), "arc").where(F.col("rank").between(F.col("first"), F.col("last"))).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
        (F.col("slot") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
