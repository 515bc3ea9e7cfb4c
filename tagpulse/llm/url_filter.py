"""URL filter: host and path rules, then a tree of path templates per host.

Every page walks down its host's tree, one path segment a level:

* Segments that a node sees on ``MIN_PAGES`` pages or more are branches of their own, however large
  the node; all others are variable and become the wildcard ``*``.
* Branches of a node are ordered by their smoothed share of bad labelled pages, and
  neighbours merge unless a two-proportion test tells them apart; one with less than ``PRIOR`` labels
  goes with the one before it.  Merged branches go on as one, named
  by their segments; of more than ``NAMES`` the first, and ``+`` the number of others.

What a page has walked is its template.  A template's purity is its share of bad labelled
pages, smoothed towards its host's, and that towards the share over all; templates at ``REJECT``
or more are blocked.

Every level costs aggregates with partial sums over all pages and joins with small tables of
nodes; a host with a third of the pages is pre-aggregated, and its pages are never
gathered.  A node has a branch for every ``MIN_PAGES`` of its pages at most.  There is no greatest depth: all
pages walk ``EVEN_DEPTH`` segments, and then those of nodes that could still split, until there are none.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule and is
judged by its tree like others; rows with the same page id are judged each by its url; labels
with null are ignored, and a page with several labels is bad if one is; without labels nothing
is blocked but by rule; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagpulse.llm.common import materialize

# The rules (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
MIN_PAGES = 20
#: No share of its node is asked of a branch; the tests' model reads this.
MIN_SHARE = 0.0
#: Siblings differ in every name, so the first ones tell them apart.
NAMES = 50
#: No depth ends the walk; the tests' model reads this.
MAX_DEPTH = float("inf")
EVEN_DEPTH = 6
SIMILAR_Z = 1.96
PRIOR = 10.0
REJECT = 0.5
NODE = ["host", "node"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule that fits, as a struct ``(rule, verdict)``; null if none does."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    return F.coalesce(F.lit(None), *[
        F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
               F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in longest])


def _smoothed(bad: Column, labelled: Column, prior: Column) -> Column:
    return (bad + F.lit(PRIOR) * prior) / (labelled + F.lit(PRIOR))


def _differ(a: Column, b: Column) -> Column:
    """Whether the shares of bad pages in two structs ``(bad, labelled)`` differ by more than chance."""
    n_a, n_b = F.greatest(a["labelled"], F.lit(1)), F.greatest(b["labelled"], F.lit(1))
    pooled = (a["bad"] + b["bad"]) / F.greatest(a["labelled"] + b["labelled"], F.lit(1))
    return F.abs(a["bad"] / n_a - b["bad"] / n_b) > SIMILAR_Z * F.sqrt(pooled * (1 - pooled) * (1 / n_a + 1 / n_b))


def _closed(classed: DataFrame) -> DataFrame:
    """Classes whose ends differ are halved, each branch going to the nearer end, until no class has ends that differ.

    Neighbours may differ by chance alone all the way from a clean branch to a bad one."""
    of = [*NODE, "class"]
    known = F.col("labelled") >= PRIOR
    while True:
        ends = classed.where(known).groupBy(*of).agg(
            F.min(F.struct("rate", "bad", "labelled")).alias("low"), F.max(F.struct("rate", "bad", "labelled")).alias("high"))
        wide = materialize(ends.where(_differ(F.col("low"), F.col("high"))).select(*of, F.col("low.rate").alias("low"), F.col("high.rate").alias("high")), "url-wide")
        if wide.isEmpty():
            return classed
        upper = F.coalesce(F.col("rate") - F.col("low") > F.col("high") - F.col("rate"), F.lit(False)).cast("long")
        halved = F.when(F.col("low").isNotNull(), F.concat("class", F.lit("."), upper)).otherwise(F.col("class"))
        classed = materialize(classed.join(wide, of, "left").withColumn("class", halved).drop("low", "high"), "url-classed")


def _level(walk: DataFrame, depth: int, overall: float) -> DataFrame:
    """All pages one segment further down.  A node's key is made of class numbers; names are for display only."""
    walk = walk.withColumn("segment", F.coalesce(F.get("segments", F.lit(depth)), F.lit("")))
    sums = [F.count(F.lit(1)).alias("pages"), F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")]
    nodes = materialize(walk.groupBy(*NODE).agg(*sums), "url-nodes")
    often = walk.groupBy(*NODE, "segment").agg(*sums).where(F.col("pages") >= MIN_PAGES)
    literal = materialize(often.withColumnRenamed("segment", "name"), "url-branches")
    own = literal.groupBy(*NODE).agg(*[F.sum(c).alias(f"own_{c}") for c in ("pages", "labelled", "bad")])
    rest = (nodes.join(own, NODE, "left").select(*NODE, F.lit("*").alias("name"), *[
        (F.col(c) - F.coalesce(f"own_{c}", F.lit(0))).alias(c) for c in ("pages", "labelled", "bad")]).where("pages > 0"))
    # A literal segment "*" is marked, so that it is not taken for the wildcard.
    branches = literal.withColumn("kind", F.lit(0)).unionByName(rest.withColumn("kind", F.lit(1)))
    by_rate = Window.partitionBy(*NODE).orderBy("rate", "kind", "name")
    rated = branches.withColumn("rate", _smoothed(F.col("bad"), F.col("labelled"), F.lit(overall)))
    # Branches with few labels stand between others without telling anything; they would bridge what is apart.
    known_rate = F.col("labelled") >= PRIOR
    own_counts = F.struct("bad", "labelled")
    before = F.last(F.when(known_rate, own_counts), ignorenulls=True).over(by_rate.rowsBetween(Window.unboundedPreceding, -1))
    apart = known_rate & _differ(own_counts, F.col("before"))
    classed = rated.withColumn("before", before).withColumn("new", F.coalesce(apart, F.lit(False)).cast("int")) \
        .withColumn("class", F.sum("new").over(by_rate).cast("string"))
    shown = F.when(F.col("kind") == 1, "*").otherwise(F.col("name"))
    classed = materialize(classed.select(*NODE, "class", "kind", "name", "rate", "bad", "labelled", shown.alias("shown")), "url-classed")
    classed = _closed(classed)
    place = F.row_number().over(Window.partitionBy(*NODE, "class").orderBy("shown", "kind"))
    listed = classed.withColumn("place", place).groupBy(*NODE, "class").agg(
        F.count(F.lit(1)).alias("of"), F.sort_array(F.collect_list(F.when(F.col("place") <= NAMES, F.col("shown")))).alias("names"))
    more = F.when(F.col("of") > NAMES, F.concat(F.lit("|+"), F.col("of") - NAMES)).otherwise("")
    named = listed.select(*NODE, "class", F.concat("node", F.lit("/"), "class").alias("next"),
                          F.concat(F.lit("/{"), F.concat_ws("|", "names"), more, F.lit("}")).alias("step"))
    known = materialize(classed.join(named, [*NODE, "class"]).select(*NODE, "kind", "name", "next", "step"), "url-classes")
    literals = known.where("kind = 0").select(*NODE, F.col("name").alias("segment"), "next", "step")
    wild = known.where("kind = 1").select(*NODE, F.col("next").alias("wild"), F.col("step").alias("wild_step"))
    return (walk.join(literals, [*NODE, "segment"], "left").join(wild, NODE, "left")
            .select("page_id", "url", "segments", "labelled", "bad", "host", "path", F.coalesce("next", "wild").alias("node"),
                    F.concat("template", F.coalesce("step", "wild_step")).alias("template")))


def _unsettled(walk: DataFrame, depth: int) -> DataFrame:
    """The nodes that could still split: labels of both kinds, pages enough for a branch, different paths, a further segment."""
    sums = walk.groupBy(*NODE).agg(
        F.count(F.lit(1)).alias("pages"), F.sum("labelled").alias("n"), F.sum("bad").alias("b"), F.max(F.size("segments")).alias("deepest"),
        F.min("path").alias("low"), F.max("path").alias("high"))
    going = sums.where((F.col("pages") >= MIN_PAGES) & (F.col("b") > 0) & (F.col("b") < F.col("n")) & (F.col("deepest") > depth) & (F.col("low") < F.col("high")))
    return materialize(going.select(*NODE), "url-unsettled")


def templates(pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, url, host, path, template, purity`` of every page; ``labels``: ``(page_id, bad 0 or 1)``."""
    host, path = host_and_path(F.col("url"))
    one = labels.where("bad is not null and page_id is not null").groupBy("page_id").agg(F.max("bad").cast("long").alias("bad"))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")).join(one, "page_id", "left")
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    walk = materialize(rows.withColumn("host", host).withColumn("path", path).select(
        "page_id", "url", "host", "path", segments.alias("segments"), F.col("bad").isNotNull().cast("long").alias("labelled"),
        F.coalesce("bad", F.lit(0)).alias("bad"), F.lit("").alias("node"), F.lit("").alias("template")), "url-walk")
    total = walk.agg(F.sum("labelled"), F.sum("bad"), F.max(F.size("segments"))).first()
    overall = (total[1] or 0) / total[0] if total[0] else 0.0
    for depth in range(min(total[2] or 0, EVEN_DEPTH)):
        walk = materialize(_level(walk, depth, overall), "url-walk")
    settled = []
    for depth in range(EVEN_DEPTH, total[2] or 0):
        going = _unsettled(walk, depth)
        if going.isEmpty():
            break
        settled.append(materialize(walk.join(going, NODE, "left_anti"), "url-settled"))
        walk = materialize(_level(walk.join(going, NODE, "left_semi"), depth, overall), "url-walk")
    for rows in settled:
        walk = walk.unionByName(rows)
    hosts = walk.groupBy("host").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b")).select(
        "host", _smoothed(F.col("b"), F.col("n"), F.lit(overall)).alias("host_rate"))
    leaves = walk.groupBy(*NODE).agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"))
    purity = materialize(leaves.join(hosts, "host").select(
        *NODE, _smoothed(F.col("b"), F.col("n"), F.col("host_rate")).alias("purity")), "url-purity")
    return walk.join(purity, NODE).select("page_id", "url", "host", "path", "template", "purity")


def judge(pages: DataFrame, labels: DataFrame, rules: tuple = RULES, reject: float = REJECT) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every page."""
    rule = matched_rule(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    return templates(pages, labels).select(
        "page_id", "host", "path", rule["rule"].alias("rule"), F.coalesce(rule["verdict"], method).alias("verdict"), "template", "purity")
