"""Document fingerprints by spot signatures (SpotSigs).

A signature is a common word (the anchor) with the chain of the ``CHAIN`` content words that follow it;
a document's fingerprint is the set of its signatures, and likeness is Jaccard's.  Words are runs of letters
and digits, lower-cased.  With ``A`` the positions of the anchors and ``C`` the content words, the j-th anchor's
chain starts at ``C[A[j] - j]``, so a document takes linear time at any length.

DataFrame functions only.  ``neighbours`` gives each document the next one in descending order of id: documents are
dealt to ordered buckets, the first document of each bucket is also sent to the bucket before it, and a
window within the bucket does the rest.  Texts are shuffled once.  ``near_pairs`` joins documents on
the rarest signatures of each, within partitions by set length; sets of equal signatures are one class.

Defined results: a null or empty text has the empty fingerprint; two empty fingerprints are alike (1), an empty
and another are not (0).  A text without anchors starts a chain at every word; one without words has one
signature, of the text itself.  A null id is the smallest; rows with the same id are ordered by a hash of the text.
The only document is its own next.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.common import bucket_of, materialize, order_bounds

CHAIN = 3
# Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is that it was for on are as with be at by this an or from not have "
    "der die das und ist von den mit zu auf für im ein eine nicht "
    "le la les et de des du un une est que dans pour pas il elle avec "
    "el los las y en se del por con su para como más").split()


def signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """Adds the sorted set of signatures of a text column (``array<int>``)."""
    words, content, chains = f"_{out}_words", f"_{out}_content", f"_{out}_chains"
    split = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    df = df.withColumn(words, split)
    df = df.withColumn(content, F.filter(words, lambda w: ~w.isin(ANCHORS)))
    # Hash of the chain that starts at each content word; shorter at the end of the text.
    shifted = F.arrays_zip(*[F.slice(content, i + 1, F.greatest(F.size(content), F.lit(1))).alias(f"c{i}") for i in range(chain)])
    df = df.withColumn(chains, F.transform(shifted, lambda z: F.hash(*[z[f"c{i}"] for i in range(chain)])))
    at = F.filter(F.transform(words, lambda w, i: F.when(w.isin(ANCHORS), F.struct(w.alias("w"), i.alias("i")))), lambda x: x.isNotNull())
    spots = F.transform(at, lambda a, j: F.hash(a["w"], F.get(F.col(chains), a["i"] - j)))
    found = F.when(F.size(spots) > 0, spots).when(F.size(chains) > 0, F.col(chains)).when(
        F.length(F.coalesce(F.col(text), F.lit(""))) > 0, F.array(F.hash(text))).otherwise(F.array().cast("array<int>"))
    return df.withColumn(out, F.sort_array(F.array_distinct(found))).drop(words, content, chains)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def as_text(signature_set: Column) -> Column:
    return F.array_join(signature_set.cast("array<string>"), " ")


def neighbours(docs: DataFrame) -> DataFrame:
    """Adds ``next_text`` and ``next_signatures`` to rows ``doc_id, text``; with ``signatures`` of their own."""
    bounds = order_bounds(docs, "doc_id")
    rows = docs.select(bucket_of(F.col("doc_id"), bounds).alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # The largest id of each bucket, of which there is a fixed number at most.
    tops = sorted((r["bucket"], r["top"]) for r in rows.groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    follows = docs.sparkSession.createDataFrame(
        [(bucket, tops[i - 1][1]) for i, (bucket, _) in enumerate(tops)], "target int, top bigint")
    guests = rows.join(F.broadcast(follows), F.col("doc_id").eqNullSafe(F.col("top"))).select(
        F.col("target").alias("bucket"), "doc_id", "text", F.lit(1).alias("guest"))
    dealt = rows.select("bucket", "doc_id", "text", F.lit(0).alias("guest")).unionByName(guests).repartition("bucket")
    order = Window.partitionBy("bucket").orderBy("guest", F.desc_nulls_last("doc_id"), "tie", "text")
    ready = signatures(dealt.withColumn("tie", F.xxhash64("text")), "text", "signatures")
    return (ready.withColumn("next_text", F.lead("text").over(order)).withColumn("next_signatures", F.lead("signatures").over(order))
            .where("guest = 0").drop("guest", "bucket", "tie"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likeness (the columns of the registered query)."""
    rows = neighbours(docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - half), F.substr(F.col("next_text"), F.lit(1), half))
    # The text is read by several functions below; a column of its own keeps it from being put together again for each.
    rows = signatures(rows.withColumn("n_chars", n.cast("long")).withColumn("edited", edited), "edited", "edited_signatures")
    own, new = F.col("signatures"), F.col("edited_signatures")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), as_text(own).alias("fingerprint"),
        as_text(new).alias("edited_fingerprint"), likeness(own, new).alias("near_edited"),
        likeness(own, F.col("next_signatures")).alias("near_next"))


def near_pairs(docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(pairs, members)``: pairs ``(a, b, likeness)`` of class representatives, and each document's class.

    Sets are partitioned by the logarithm of their length, so that those alike lie in the same partition or the next.
    Of each set only the rarest signatures are joined, as many as a set alike must share one of."""
    fps = materialize(signatures(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text", "signatures")
                      .select("doc_id", "signatures"), "spots")
    classes = materialize(fps.groupBy("signatures").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "spot-classes")
    members = fps.join(classes.select("signatures", "rep"), "signatures").select("doc_id", F.col("rep").alias("class_id"))
    sets = classes.where(F.size("signatures") > 0).select(F.col("rep").alias("id"), "signatures", F.size("signatures").alias("n"))
    each = sets.select("id", "n", F.explode("signatures").alias("s"))
    rarity = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("df", "s"))
    prefix = materialize(each.join(rarity, "s").withColumn("rank", rank)
                         .where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
                         .select("id", "n", "s", (F.floor(F.log("n") / F.lit(-math.log(threshold)) + 1e-9) if threshold < 1 else F.col("n").cast("long")).alias("part")), "spot-prefixes")
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("n_a"), "s", "part")
    right = prefix.select(F.col("id").alias("b"), F.col("n").alias("n_b"), "s", F.explode(F.array(F.col("part"), F.col("part") - 1)).alias("part"))
    fits = (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold - 1e-9) & (F.col("a") != F.col("b"))
    candidates = left.join(right, ["s", "part"]).where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one, two = (sets.select(F.col("id").alias(c), F.col("signatures").alias(f"s_{c}")) for c in "ab")
    pairs = candidates.join(one, "a").join(two, "b").select("a", "b", likeness(F.col("s_a"), F.col("s_b")).alias("likeness"))
    return pairs.where(F.col("likeness") >= threshold), members
