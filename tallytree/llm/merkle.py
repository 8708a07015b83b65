"""Merkle manifest of a table, with proofs looked up by coordinates.

Every row is a leaf, a group's leaves in order are a tree whose nodes have ``FAN``
children, and the groups' roots in order are the leaves of one more tree. A node is
addressed by (tree, height, number): its tree is the group's place in the order of
groups (``TOP`` for the tree of groups), its height counts from the leaves' parents.

Numbers come from a range sort: a row's number is its place in its partition and the
rows of its group in earlier partitions. Nodes are built height by height and kept as
tables: a node's row holds its children's digests end to end, so that a child's
siblings are that text without the child. A run of leaves explodes the coordinates of
the nodes above it, which follow from its number and the group's size; they are joined
with the table of nodes, put in order, and concatenated or folded. All of it is
DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, matched, written

#: Children of a node; characters of a digest.
FAN, DIGEST = 8, 64
#: Nodes that may be broadcast (a row is FAN digests): those of the upper heights, as
#: many heights as fit. Of the heights below, a node has few runs under it.
BROADCAST_NODES = 20_000
#: The tree of groups, and what is added to its heights, so that they are above all others.
TOP, ABOVE = -1, 100


def digest(*parts: Column) -> Column:
    """sha256 as lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, order: list[str], group: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` sorted, with ``part`` and ``at`` (both of the sort), and for each
    (group, part) ``first``, ``before`` (the group's rows in earlier parts), ``size``
    (its rows there)."""
    # equal rows are dealt to several partitions by where they were read
    sort = rows.withColumn("_read", F.monotonically_increasing_id())
    sort = sort.repartitionByRange(*order, "_read").sortWithinPartitions(*order, "_read").drop("_read")
    place = sort.withColumn("at", F.monotonically_increasing_id())
    ordered = written(place.withColumn("part", F.shiftright("at", 33)))
    parts = ordered.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("size"))
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ordered, written(parts.withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0).cast("long"))))


def heights(n: Column) -> Column:
    """How many heights of nodes a tree of n leaves has: none over a lone leaf."""
    powers = F.array(*(F.lit(FAN**k).cast("long") for k in range(21)))
    return F.size(F.filter(powers, lambda p: p < n))


def parents(nodes: DataFrame, height: int) -> DataFrame:
    """Nodes over ``nodes`` (tree, number, digest, n: nodes of that height in the tree):
    ``tree``, ``height``, ``number``, ``children``, ``digest``, ``n``."""
    run = nodes.select("tree", F.struct("number", "digest").alias("child"), F.expr(f"number div {FAN}").alias("number"), "n").groupBy("tree", "number")
    in_order = F.transform(F.array_sort(F.collect_list("child")), lambda x: x["digest"])  # at most FAN
    got = run.agg(F.array_join(in_order, "").alias("children"), F.max("n").alias("n"))
    return got.select("tree", F.lit(height).alias("height"), "number", "children", digest(F.col("children")).alias("digest"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"))


def built(leaves: DataFrame, above: int = 0) -> DataFrame:
    """All nodes over leaves (tree, number, digest, n), as a table."""
    level = leaves
    most = leaves.agg(F.max("n")).first()[0] or 0
    out, height = None, 0
    while most > 1:
        level = written(parents(level.where("n > 1"), height + above))
        out = level if out is None else out.unionByName(level)
        most, height = -(-most // FAN), height + 1
    if out is None:
        return leaves.where("false").select("tree", F.lit(0).alias("height"), "number", F.lit("").alias("children"), "digest", "n")
    return out


@dataclass
class Manifest:
    """Leaves in their places (``tree``, ``number``, ``n``, ``key``, ``digest``, and what
    was carried), all ``nodes``, ``groups`` (``tree``, ``n``, ``subroot``), the ``root``
    (null without rows) and the number of groups."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None
    n_groups: int


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), key: str = "doc_id", group: str = "lang", **carry: Column) -> Manifest:
    """The trees of ``docs``. A leaf is the digest of its ``fields``, each ``-`` if null,
    else its length in bytes, ``:`` and the value. A group's leaves ascend by ``key``
    (null first), equal keys by digest; groups ascend bytewise, null first.

    Null and empty texts, long ones, and rows that repeat are leaves like any other.
    ``carry`` names further columns, computed of a row, that its leaf takes along.
    Other columns are ignored. An empty table has no leaves and no root.
    """
    rows = docs.select(F.col(group).alias("_group"), F.col(key).alias("key"), digest(*(encoded(F.col(f)) for f in fields)).alias("digest"), *(c.alias(n) for n, c in carry.items()))
    ordered, parts = numbered(rows, ["_group", "key", "digest"], "_group")
    sizes = parts.groupBy("_group").agg(F.sum("size").alias("n"))
    # the groups' own order, by the same means
    lined, dealt = numbered(sizes.withColumn("one", F.lit(1)), ["_group"], "one")
    numbers = lined.join(dealt.select("part", "first", "before"), "part").select("_group", "n", (F.col("at") - F.col("first") + F.col("before")).alias("tree"))
    numbers = written(numbers)
    n_groups = numbers.count()
    told = parts.withColumnRenamed("_group", "_g").join(numbers, F.col("_g").eqNullSafe(F.col("_group"))).select("_g", F.col("part").alias("_p"), "first", "before", "tree", "n")
    leaves = ordered.join(written(told), F.col("_group").eqNullSafe(F.col("_g")) & (F.col("part") == F.col("_p")))
    leaves = written(leaves.select("tree", (F.col("at") - F.col("first") + F.col("before")).alias("number"), "n", "key", "digest", *carry))
    nodes = built(leaves.select("tree", "number", "digest", "n"))
    groups = written(leaves.where("n = 1").select("tree", F.col("digest").alias("subroot")).unionByName(nodes.where("n = 1").select("tree", F.col("digest").alias("subroot"))).join(numbers.select("tree", "n"), "tree"))
    top = built(groups.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("number"), F.col("subroot").alias("digest"), F.lit(n_groups).cast("long").alias("n")), ABOVE)
    last = groups.select("subroot").first() if n_groups == 1 else top.where("n = 1").select("digest").first()
    discard(ordered, parts, lined, dealt, numbers)
    return Manifest(leaves, written(nodes.unionByName(top)), groups, last[0] if last else None, n_groups)


def coordinates(n: Column, number: Column, tree: Column, first: int, above: int) -> Column:
    """Of a leaf of a tree of n leaves: the nodes over it from height ``first`` on, as
    (height, tree, number, pos), pos being the place of the node below among the children."""
    step = lambda h: F.struct(
        (h + above).cast("int").alias("height"), tree.cast("long").alias("tree"), F.floor(number / F.pow(F.lit(float(FAN)), h + 1)).cast("long").alias("number"), (F.floor(number / F.pow(F.lit(float(FAN)), h)) % FAN).cast("int").alias("pos"),
    )
    none = F.expr("cast(array() as array<struct<height:int,tree:bigint,number:bigint,pos:int>>)")
    return F.when(heights(n) > first, F.transform(F.sequence(F.lit(first), heights(n) - 1), step)).otherwise(none)


def looked_up(asked: DataFrame, nodes: DataFrame, by: list[str]) -> DataFrame:
    """``by`` and ``steps`` (height, pos, children; in order) of rows (``by``,
    ``coords``). The upper heights' nodes, which many ask for, are few and broadcast."""
    wanted = asked.select(*by, F.explode("coords").alias("c")).select(*by, "c.*")
    counts = {r["height"]: r["count"] for r in nodes.groupBy("height").count().collect()}  # some twenty heights
    upper, total = max(counts, default=0) + 1, 0
    for height in sorted(counts, reverse=True):
        total += counts[height]
        if total > BROADCAST_NODES:
            break
        upper = height
    on, node = ["height", "tree", "number"], nodes.select("height", "tree", "number", "children")
    met = wanted.where(F.col("height") >= upper).join(F.broadcast(node.where(F.col("height") >= upper)), on)
    if any(h < upper for h in counts):
        met = met.unionByName(wanted.where(F.col("height") < upper).join(node.where(F.col("height") < upper), on))
    # a row has as many steps as its tree has heights
    return met.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("height", "pos", "children"))).alias("steps"))


#: Steps with the siblings of what is proved, left and right of it.
STEPS = "array<struct<left:string,right:string>>"


def siblings(steps: Column) -> Column:
    cut = lambda s: F.struct(F.substring(s["children"], F.lit(1), s["pos"] * DIGEST).alias("left"), F.substring(s["children"], (s["pos"] + 1) * DIGEST + 1, F.lit(FAN * DIGEST)).alias("right"))
    return F.coalesce(F.transform(steps, cut), F.expr(f"cast(array() as {STEPS})"))


def proofs(m: Manifest) -> DataFrame:
    """Of each leaf: what ``leaves`` has, ``subroot``, and ``steps``: the digests (end
    to end) of its siblings left and right of it, from the leaf's height to the root."""
    carried = [c for c in m.leaves.columns if c not in ("tree", "number", "n")]
    leaf = F.struct((F.col("number") % FAN).cast("int").alias("pos"), *carried)
    runs = m.leaves.groupBy("tree", F.expr(f"number div {FAN}").alias("run")).agg(F.collect_list(leaf).alias("leaves"), F.max("n").alias("n"))  # FAN rows at most
    runs = written(runs)
    start = F.col("run") * FAN
    above = looked_up(runs.select("tree", "run", coordinates(F.col("n"), start, F.col("tree"), 1, 0).alias("coords")).withColumnRenamed("tree", "of"), m.nodes, ["of", "run"])
    whole = runs.join(above.withColumnRenamed("of", "tree"), ["tree", "run"], "left").withColumn("above", siblings(F.col("steps"))).drop("steps")
    whole = written(whole)
    # the tree of groups: once a group
    of_group = looked_up(m.groups.select(F.col("tree").alias("of"), coordinates(F.lit(m.n_groups).cast("long"), F.col("tree"), F.lit(TOP), 0, ABOVE).alias("coords")), m.nodes, ["of"])
    tops = m.groups.join(of_group.withColumnRenamed("of", "tree"), "tree", "left").select("tree", "subroot", siblings(F.col("steps")).alias("top"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("times"))
    joined = matched(whole, written(tops), ["tree"], "inner")
    digests = F.transform(F.array_sort("leaves"), lambda x: x["digest"])
    own = F.when(F.col("n") > 1, F.array(F.struct(F.array_join(F.slice("digests", 1, F.col("leaf.pos")), "").alias("left"), F.array_join(F.slice("digests", F.col("leaf.pos") + 2, FAN), "").alias("right")))).otherwise(F.expr(f"cast(array() as {STEPS})"))
    each = joined.withColumn("digests", digests).withColumn("leaf", F.explode("leaves"))
    return each.select(*(F.col("leaf")[c].alias(c) for c in carried), "subroot", F.concat(own, "above", "top").alias("steps"))


def told(steps: Column) -> Column:
    """All siblings of a proof, from the leaf up, left to right."""
    return F.aggregate(steps, F.lit(""), lambda all_, s: F.concat(all_, s["left"], s["right"]))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda at, s: digest(s["left"], at, s["right"]))
