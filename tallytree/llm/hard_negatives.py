"""Hard negatives by branch and bound over ball trees.

The vectors are dealt to pages by a hash of their keys, and each page is a ball tree:
its rows are parted by label first, and below that split at the median between two far
points, so that every node knows its ball and, where it has one, its label. For a query
q a node with centre c and radius r has only inner products between ``q c - |q| r`` and
``q c + |q| r``. A node is left out if that range misses the windows of scores that a
query asks for, or lies strictly beneath what the query's k-th best has already.

Queries are packed into blocks; every block meets every page, and a group of Spark is
one block with one page. Two passes: the best rows of a query's own label, whose scores
then are the windows in which the best rows of other labels are searched. Before each
pass over all pages a sixteenth of them gives every window a first floor, so that what
leaves a page doesn't grow with the number of pages.

Components are scaled to whole numbers, so all scores are exact.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .neighbours import matrix

#: Rows of a page, queries of a block, rows of a tree's leaf.
PAGE, BLOCK, LEAF = 8192, 512, 64
#: One page in so many gives first floors.
DRAWN = 16
#: Scaled components are at most so large either way; products of rows of up to 2 ** 17 of them fit 64 bits.
MOST = 1 << 23
#: Scores of nothing.
NONE = -(1 << 62)


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {k: found[k] for k in found.files}


def ball_tree(x: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """Nodes as arrays: centre, radius, label (-1 where ``mixed``), rows from ``lo`` up
    to ``hi`` in the tree's order, first child (the second is next to it; -1 at a leaf)."""
    order = np.lexsort((ids, labels))
    todo, nodes = [(0, 0, len(x))], [None]
    while todo:
        at, lo, hi = todo.pop()
        rows = order[lo:hi]
        v, own = x[rows].astype(float), labels[rows]
        centre = v.mean(0) if len(v) else np.zeros(x.shape[1])
        away = ((v - centre) ** 2).sum(1)
        mixed, child = bool(len(own)) and own[0] != own[-1], -1
        if mixed:  # rows are in order of labels until a node has one
            cut = lo + int(np.searchsorted(own, own[len(own) // 2], "left"))
            cut = cut if cut > lo else lo + int(np.searchsorted(own, own[0], "right"))
        elif hi - lo > leaf:
            far = v[away.argmax()]
            axis = v[((v - far) ** 2).sum(1).argmax()] - far
            order[lo:hi] = rows[np.argsort(v @ axis, kind="stable")]
            cut = (lo + hi) // 2
        if mixed or hi - lo > leaf:
            child = len(nodes)
            todo += [(child, lo, cut), (child + 1, cut, hi)]
            nodes += [None, None]
        radius = math.sqrt(away.max()) * (1 + 1e-9) + 1e-6 if len(v) else 0.0
        nodes[at] = (centre, radius, own[0] if len(own) and not mixed else -1, mixed, lo, hi, child)
    columns = [np.array(c) for c in zip(*nodes, strict=True)]
    return dict(zip(("centre", "radius", "label", "mixed", "lo", "hi", "child"), columns, strict=True)) | {"x": x[order], "ids": ids[order], "labels": labels[order]}


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly."""
    top = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if top < 2**53:
        return (q.astype(float) @ x.T.astype(float)).astype(np.int64)
    return q.astype(np.int64) @ x.T.astype(np.int64)


def search(tree: dict[str, np.ndarray], block: dict[str, np.ndarray], k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(query, window, key, score) of the k best rows of a tree for each window of each
    query of a block, if they reach the window's floor: of the query's label or, unless
    ``same``, of any other. Equal scores are ordered by key."""
    q, ids, labels, low, high = (block[c] for c in ("q", "ids", "labels", "low", "high"))
    n, w = low.shape
    # what a further row has to beat: the floor, or the k-th best found
    bar, bar_id = block["floor"].copy(), block["floor_id"].copy()
    best = np.full((n, w, k), NONE, np.int64)
    best_id = np.full((n, w, k), np.iinfo(np.int64).max)
    norm = np.sqrt((q.astype(float) ** 2).sum(1))
    qf = q.astype(float)
    stack = [(0, np.arange(n))]
    while stack:
        node, rows = stack.pop()
        if not tree["mixed"][node]:
            rows = rows[(labels[rows] == tree["label"][node]) == same]
        if not len(rows):
            continue
        middle = qf[rows] @ tree["centre"][node]
        reach = norm[rows] * tree["radius"][node]
        slack = 1e-6 + 1e-9 * (np.abs(middle) + reach)
        upper, lower = (middle + reach + slack)[:, None], (middle - reach - slack)[:, None]
        open_ = ((upper >= low[rows]) & (lower <= high[rows]) & (upper >= bar[rows])).any(1)
        rows, middle = rows[open_], middle[open_]
        if not len(rows):
            continue
        child = tree["child"][node]
        if child >= 0:
            toward = (qf[rows] @ (tree["centre"][child] - tree["centre"][child + 1])).mean()
            near = child if toward > 0 else child + 1
            stack += [(2 * child + 1 - near, rows), (near, rows)]
            continue
        at = slice(tree["lo"][node], tree["hi"][node])
        s, keys = products(q[rows], tree["x"][at]), tree["ids"][at]
        other = keys[None, :] != ids[rows][:, None]
        for j in range(w):
            b, b_id = bar[rows, j][:, None], bar_id[rows, j][:, None]
            hit = other & (s >= low[rows, j][:, None]) & (s <= high[rows, j][:, None]) & ((s > b) | ((s == b) & (keys[None, :] <= b_id)))
            for i in np.flatnonzero(hit.any(1)):
                r = rows[i]
                scores, found = np.append(best[r, j], s[i][hit[i]]), np.append(best_id[r, j], keys[hit[i]])
                first = np.lexsort((found, -scores))[:k]
                best[r, j], best_id[r, j] = scores[first], found[first]
                if best[r, j, -1] > NONE:
                    bar[r, j], bar_id[r, j] = best[r, j, -1], best_id[r, j, -1]
    r, j, m = np.nonzero(best > NONE)
    return r, j, best_id[r, j, m], best[r, j, m]


def scaled(vector: Column, by: int) -> Column:
    """floor(by * x) of each component, as a double, in whole numbers of at most ``MOST``."""
    return F.transform(vector, lambda x: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(x.cast("double") * by))).cast("int"))


def part_in_it(vectors: DataFrame, key: str, vector: str, label: Column, by: int) -> DataFrame:
    """``id``, ``v`` (scaled), ``label`` of the rows that take part, one a key."""
    c = F.col(vector)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.select(F.col(key).cast("long").alias("id"), scaled(c, by).alias("v"), label.cast("long").alias("label"), F.coalesce(finite, F.lit(False)).alias("finite"))
    rows = rows.where("id IS NOT NULL AND label IS NOT NULL AND finite AND size(v) > 0").drop("finite")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.where(F.size("v") == (common["n"] if common else 1))
    return rows.groupBy("id").agg(F.min(F.struct("v", "label")).alias("r")).select("id", "r.*")


def pages_of(rows: DataFrame, n: int) -> DataFrame:
    """``page`` and ``tree`` of each of n pages."""

    def build(group: pa.Table) -> pa.Table:
        x = matrix(group.column("v").combine_chunks()).astype(np.int32)
        tree = ball_tree(x, group.column("id").to_numpy(), group.column("label").to_numpy())
        return pa.table({"page": group.column("page").slice(0, 1), "tree": pa.array([packed(**tree)], pa.binary())})

    placed = rows.withColumn("page", F.pmod(F.xxhash64("id", F.lit("page")), F.lit(n)).cast("int"))
    return written(placed.groupBy("page").applyInArrow(build, "page int, tree binary"))


#: Queries with their windows: key, label, vector, and of each window its name, ends and floor.
ASKED = "id long, label long, v array<int>, windows array<struct<name:long,low:long,high:long,floor:long,floor_id:long>>"


def blocks_of(asked: DataFrame, n: int, width: int) -> DataFrame:
    """Queries (``ASKED``) in n blocks: ``block``, ``queries``; a query of fewer than
    ``width`` windows has empty ones."""

    def pack(group: pa.Table) -> pa.Table:
        rows = group.select(["id", "label", "windows"]).to_pylist()
        many = np.zeros((5, len(rows), width), np.int64)
        many[1] = 1  # empty: low over high
        for i, r in enumerate(rows):
            for j, x in enumerate(r["windows"]):
                many[:, i, j] = x["name"], x["low"], x["high"], x["floor"], x["floor_id"]
        q = matrix(group.column("v").combine_chunks()).astype(np.int32)
        data = packed(q=q, ids=np.array([r["id"] for r in rows]), labels=np.array([r["label"] for r in rows]), name=many[0], low=many[1], high=many[2], floor=many[3], floor_id=many[4])
        return pa.table({"block": group.column("block").slice(0, 1), "queries": pa.array([data], pa.binary())})

    placed = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit("block")), F.lit(n)).cast("int"))
    return written(placed.groupBy("block").applyInArrow(pack, "block int, queries binary"))


def searched(blocks: DataFrame, n_blocks: int, pages: DataFrame, numbers: Column, k: int, same: bool) -> DataFrame:
    """``id``, ``name``, ``other``, ``score``: what each block finds in each of the
    pages whose ``numbers`` are given, k at most a window and page."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.zeros(0, np.int64)] * 4
        if left.num_rows and right.num_rows:
            block, tree = unpacked(left.column("queries")[0].as_py()), unpacked(right.column("tree")[0].as_py())
            r, j, other, score = search(tree, block, k, same)
            out = [block["ids"][r], block["name"][r, j], other, score]
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("id", "name", "other", "score"), out, strict=True)})

    asking = blocks.withColumn("page", F.explode(numbers))
    asked = pages.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    return asking.groupBy("block", "page").cogroup(asked.groupBy("block", "page")).applyInArrow(run, "id long, name long, other long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each window, numbered."""
    order = Window.partitionBy("id", "name").orderBy(F.desc("score"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top(asked: DataFrame, pages: DataFrame, n_pages: int, n_queries: int, k: int, same: bool, width: int) -> DataFrame:
    """``best`` of all pages for queries (``ASKED``)."""
    n = max(1, math.ceil(n_queries / BLOCK))
    every = F.sequence(F.lit(0), F.lit(n_pages - 1))
    if n_pages > DRAWN:
        some = F.sequence(F.lit(0), F.lit(n_pages - 1), F.lit(DRAWN))
        first = best(searched(blocks_of(asked, n, width), n, pages.where(F.col("page") % DRAWN == 0), some, k, same), k).where(F.col("rank") == k)
        floors = written(first.groupBy(F.col("id").alias("of")).agg(F.map_from_entries(F.collect_list(F.struct("name", F.struct("score", "other")))).alias("floors")))  # width entries
        known = lambda w, c: F.coalesce(F.col("floors")[w["name"]][c], w["floor" if c == "score" else "floor_id"])
        windows = F.transform("windows", lambda w: F.struct(w["name"].alias("name"), w["low"].alias("low"), w["high"].alias("high"), known(w, "score").alias("floor"), known(w, "other").alias("floor_id")))
        asked = asked.join(floors, F.col("id") == F.col("of"), "left").withColumn("windows", windows).select("id", "label", "v", "windows")
    return best(searched(blocks_of(asked, n, width), n, pages, every, k, same), k)


def window(name: Column, low: Column, high: Column) -> Column:
    return F.struct(name.cast("long").alias("name"), low.cast("long").alias("low"), high.cast("long").alias("high"), F.lit(NONE).cast("long").alias("floor"), F.lit(0).cast("long").alias("floor_id"))


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column | str = "label", key: str = "vec_id", vector: str = "embedding", positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, by: int = 256
) -> DataFrame:
    """For each anchor (a row for whose ``id`` ``anchors`` holds) and each of its
    ``positives`` nearest rows of the same label, the first ``negatives`` rows of other
    labels whose score is ``low`` to ``high`` hundredths of the positive's:
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``,
    ``positive_score``, ``negative_score``.

    A score is the inner product with the anchor of components scaled to
    ``floor(by * x)``; higher ones come first, equal ones by smaller key. All rows that
    there are, where there are fewer; a positive without such rows has no row.

    Rows with a null key or label, a null or empty vector, or a null or non-finite
    component take no part, nor do those whose length isn't the commonest one (of
    equally common ones the longest). Zero vectors and repeated vectors do. A repeated
    key is one row, with the vector, then label, that sorts first. Scaled components
    beyond 2 ** 23 count as that. An empty table has no rows. Other columns are ignored.
    """
    rows = written(part_in_it(vectors, key, vector, F.col(label) if isinstance(label, str) else label, by))
    n_pages = max(1, math.ceil(rows.count() / PAGE))
    pages = pages_of(rows, n_pages)
    asking = rows.where(anchors)
    n = asking.count()
    free = window(F.lit(0), F.lit(NONE), F.lit(-NONE))
    near = written(top(asking.select("id", "label", "v", F.array(free).alias("windows")), pages, n_pages, n, positives, True, 1))
    # low * p <= 100 * s <= high * p, in whole numbers
    least = F.expr(f"(score * {low} + pmod(-score * {low}, 100)) div 100")
    most = F.expr(f"(score * {high} - pmod(score * {high}, 100)) div 100")
    mine = window(F.col("other"), least, most)
    windows = near.groupBy(F.col("id").alias("of")).agg(F.collect_list(mine).alias("windows"))  # as many as positives
    asked = written(asking.join(windows, F.col("id") == F.col("of")).select("id", "label", "v", "windows"))
    found = top(asked, pages, n_pages, n, negatives, False, positives)
    scores = near.select(F.col("id").alias("anchor"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score"))
    out = found.join(scores, (F.col("id") == F.col("anchor")) & (F.col("name") == F.col("positive_id")))
    return out.select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
