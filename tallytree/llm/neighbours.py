"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The upper tree is fitted on a bounded sample. Leaves that hold more rows of the
table than ``LEAF_ROWS`` are split again, level by level, each by k-means over a
bounded sample of its own rows, until bins are small; so bins grow in number with
the table, not in size. A query goes down the upper tree with a priority queue,
always to the nearest open node, and below it from level to level with the nearest
bins of all that are open. How many leaves and bins it visits is calibrated: of a
set of rows the true neighbours are found by brute force over the whole table, and
visits are widened until ``RECALL`` of them are met. Only the bins visited are read,
and measured exactly.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, written

#: Vectors that the upper tree is fitted on at most, rows of the calibration, recall it has to reach.
SAMPLE, CALIBRATION, RECALL = 20_000, 200, 0.97
#: Rows of a bin that isn't split again, children of one that is at most, rows that a split is fitted on, levels.
LEAF_ROWS, CHILDREN, FIT, LEVELS = 512, 32, 2048, 6
#: Open bins of a query at each level at first; more where calibration needs them.
BEAM = 1024
#: Rows, and queries, of a bin that one task takes: a bin of equal vectors, which can't be split, has several pages.
PAGE, QUERY_PAGE = 4096, 2048


@dataclass
class Tree:
    """Nodes as arrays: centre, first child (-1 at a leaf), children, leaf number."""

    centres: np.ndarray
    first: np.ndarray
    width: np.ndarray
    leaf: np.ndarray
    leaves: int

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: down to the nearest child each time."""
        out, todo = np.zeros(len(x), np.int64), [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.first[node] < 0:
                out[rows] = self.leaf[node]
                continue
            kids = slice(self.first[node], self.first[node] + self.width[node])
            near = distances(x[rows], self.centres[kids]).argmin(1)
            todo += [(self.first[node] + k, rows[near == k]) for k in range(self.width[node])]
        return out

    def best_first(self, q: np.ndarray) -> Iterator[tuple[int, float]]:
        """Leaves, and how far their centres are, in the order in which the priority queue gives them up."""
        queue = [(0.0, 0)]
        while queue:
            away, node = heapq.heappop(queue)
            if self.first[node] < 0:
                yield int(self.leaf[node]), away
                continue
            first = self.first[node]
            below = ((self.centres[first : first + self.width[node]] - q) ** 2).sum(1)
            for k, d in enumerate(below):
                heapq.heappush(queue, (float(d), int(first + k)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared, by a product: near enough to choose, not to report."""
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2 * a @ b.T, 0)


def k_means(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    centres = x[np.sort(rng.choice(len(x), k, replace=False))]
    at = np.zeros(len(x), np.int64)
    for _ in range(rounds):
        at = distances(x, centres).argmin(1)
        size = np.bincount(at, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centres)
    at = distances(x, centres).argmin(1)
    used = np.unique(at)
    return centres[used], np.searchsorted(used, at)


def fit_tree(x: np.ndarray, branching: int = 8, leaf_size: int = 48, seed: int = 5) -> Tree:
    rng = np.random.default_rng(seed)
    centres, first, width, leaf = [x.mean(0) if len(x) else np.zeros(x.shape[1])], [-1], [0], [-1]
    todo = [(0, np.arange(len(x)))]
    while todo:  # depth first, so that leaves are numbered along the tree
        node, rows = todo.pop()
        parts = None
        if len(rows) > leaf_size:
            parts = k_means(x[rows], min(branching, len(rows)), rng)
        if parts is None or len(parts[0]) < 2:
            continue
        first[node], width[node] = len(centres), len(parts[0])
        for k, c in enumerate(parts[0]):
            todo.append((len(centres), rows[parts[1] == k]))
            centres.append(c), first.append(-1), width.append(0), leaf.append(-1)
    n, stack = 0, [0]
    while stack:
        node = stack.pop()
        if first[node] < 0:
            leaf[node], n = n, n + 1
        else:
            stack += range(first[node] + width[node] - 1, first[node] - 1, -1)
    return Tree(np.array(centres), np.array(first), np.array(width), np.array(leaf), n)


def usable(vector: str) -> Column:
    """Not null, not empty, not all zero, without null or non-finite components."""
    c = F.col(vector)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(c.isNotNull() & finite & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def widened(ranks: list[float], recall: float, most: int) -> int:
    """So many visits that ``recall`` of the true neighbours, met at these ranks, are found."""
    ranks = sorted(ranks)
    return int(min(most, ranks[min(len(ranks) - 1, math.ceil(recall * len(ranks)) - 1)] + 1)) if ranks else 1


def grown(placed: DataFrame, width: int) -> tuple[DataFrame, list[DataFrame]]:
    """``placed`` (id, v, asks, bin) with the bins of more than ``LEAF_ROWS`` rows
    split, and each level's splits: ``bin`` and ``centres`` (flat) of its children,
    which are called bin.0, bin.1, ... A bin whose rows are all equal stays whole."""
    levels: list[DataFrame] = []

    def fit(rows: pa.Table) -> pa.Table:
        x, n = matrix(rows.column("v").combine_chunks()), rows.column("n")[0].as_py()
        centres, _ = k_means(x, min(CHILDREN, max(2, math.ceil(n / LEAF_ROWS)), len(x)), np.random.default_rng(len(x)))
        return pa.table({"bin": rows.column("bin").slice(0, 1), "centres": pa.array([centres.ravel().tolist()], pa.list_(pa.float64()))})

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, v, at = b.column("bin").to_pylist(), matrix(b.column("v")), {}
            for i, x in enumerate(bins):
                at.setdefault(x, []).append(i)
            centres = b.column("centres")
            for name, rows in at.items():
                if centres[rows[0]].is_valid:
                    near = distances(v[rows], np.array(centres[rows[0]].as_py()).reshape(-1, width)).argmin(1)
                    for i, k in zip(rows, near, strict=True):
                        bins[i] = f"{name}.{k}"
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("id", "v", "asks")), pa.array(bins, pa.string())], names=["id", "v", "asks", "bin"])

    whole: DataFrame | None = None  # bins that couldn't be split
    for level in range(LEVELS):
        sizes = written(placed.groupBy("bin").agg(F.count("*").alias("n")).where(F.col("n") > LEAF_ROWS))
        big = sizes if whole is None else sizes.join(whole, "bin", "left_anti")
        if big.isEmpty():
            break
        # an even draw of about FIT rows of each
        drawn = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(1 << 30)) < F.least(F.lit(1.0), F.lit(float(FIT)) / F.col("n")) * (1 << 30)
        splits = written(placed.join(F.broadcast(big) if level == 0 else big, "bin").where(drawn).select("bin", "v", "n").groupBy("bin").applyInArrow(fit, "bin string, centres array<double>"))
        stuck = splits.where(F.size("centres") <= width).select("bin")
        whole = stuck if whole is None else whole.unionByName(stuck)
        splits = splits.where(F.size("centres") > width)
        levels.append(splits)
        placed = written(placed.join(splits, "bin", "left").mapInArrow(descend, "id long, v array<double>, asks boolean, bin string"))
    return placed, levels


def below(asked: DataFrame, levels: list[DataFrame], width: int, beam: int) -> DataFrame:
    """``asked`` (q, qv, bin, d) down the levels: at each, the bins that are split
    give way to their children, and of all open bins of a query the ``beam``
    nearest stay."""

    def children(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(iter([whole]), 256):
                qv, at, names, away = matrix(b.column("qv")), [], [], []
                for i, (name, d, centres) in enumerate(zip(b.column("bin").to_pylist(), b.column("d").to_pylist(), b.column("centres"), strict=True)):
                    if centres.is_valid:
                        near = ((np.array(centres.as_py()).reshape(-1, width) - qv[i]) ** 2).sum(1)
                        names += [f"{name}.{k}" for k in range(len(near))]
                        away += near.tolist()
                        at += [i] * len(near)
                    else:
                        names.append(name), away.append(d), at.append(i)
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("q").take(at), b.column("qv").take(at), pa.array(names, pa.string()), pa.array(away, pa.float64())], names=["q", "qv", "bin", "d"])

    nearest = Window.partitionBy("q").orderBy("d", "bin")
    for splits in levels:
        asked = asked.join(splits, "bin", "left").select("q", "qv", "bin", "d", "centres").mapInArrow(children, "q long, qv array<double>, bin string, d double")
        asked = asked.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= beam).drop("rank")
    return asked


def true_neighbours(placed: DataFrame, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, str]]:
    """(query's number, bin) of the ``k`` nearest of each of a few queries, by brute force over all rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in ids]
        for whole in batches:
            for b in slices(iter([whole]), 2000):
                v, of, bins = matrix(b.column("v")), b.column("id").to_numpy(), b.column("bin").to_pylist()
                near = distances(x, v)
                near[ids[:, None] == of[None, :]] = np.inf
                for i, row in enumerate(near):
                    some = np.argpartition(row, min(k, len(row)) - 1)[:k]
                    best[i] = sorted([*best[i], *((row[j], int(of[j]), bins[j]) for j in some if row[j] < np.inf)])[:k]
        rows = [(i, *r) for i, found in enumerate(best) for r in found]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.float64(), pa.int64(), pa.string()), strict=True)], names=["i", "d", "id", "bin"])

    if not len(ids):
        return []
    found = placed.mapInArrow(scan, "i long, d double, id long, bin string")
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("i").orderBy("d", "id"))).where(F.col("rank") <= k)
    return [(r["i"], r["bin"]) for r in first.select("i", "bin").collect()]  # CALIBRATION * k rows


def index(vectors: DataFrame, queries: Column, k: int, key: str, vector: str, sample: int, recall: float) -> tuple[DataFrame, DataFrame, int, int, int]:
    """The rows in their bins (id, v, asks, bin); the bins that each query visits
    (q, qv, bin); the vectors' length; leaves and bins visited."""
    rows = vectors.where(F.col(key).isNotNull() & usable(vector)).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(queries, F.lit(False)).alias("asks"))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    width = common["n"] if common else 1
    rows = rows.where(F.size("v") == width).groupBy("id").agg(F.min("v").alias("v"), F.bool_or("asks").alias("asks"))
    drawn = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("id", "v").toArrow()
    known = matrix(drawn.column("v").combine_chunks()) if drawn.num_rows else np.zeros((0, width))
    tree = fit_tree(known)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = tree.assign(matrix(b.column("v"))) if b.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([str(x) for x in leaf], pa.string())], names=[*b.schema.names, "bin"])

    placed, levels = grown(written(rows.mapInArrow(assign, "id long, v array<double>, asks boolean, bin string")), width)
    sizes = written(placed.groupBy("bin").agg(F.count("*").alias("n")))
    leaf_rows = placed.groupBy(F.substring_index("bin", ".", 1).cast("long").alias("leaf")).agg(F.count("*").alias("n"))
    filled = {r["leaf"]: r["n"] for r in leaf_rows.collect()}  # of a tree bounded by the sample

    def leaves(visits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        """The leaves that the queue gives up first: ``visits`` that hold rows, more while they hold no more than k."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for b in slices(iter([whole]), 64):
                    at, names, away = [], [], []
                    for i, q in enumerate(matrix(b.column("v"))):
                        n = met = 0
                        for leaf, d in tree.best_first(q):
                            if n >= visits and met > k:
                                break
                            if leaf in filled:
                                at.append(i), names.append(str(leaf)), away.append(d)
                                n, met = n + 1, met + filled[leaf]
                    at = pa.array(at, pa.int64())
                    yield pa.RecordBatch.from_arrays([b.column("id").take(at), b.column("v").take(at), pa.array(names, pa.string()), pa.array(away, pa.float64())], names=["q", "qv", "bin", "d"])

        return run

    def visited(some: DataFrame, leaf_visits: int, beam: int) -> DataFrame:
        asked = some.select("id", "v").mapInArrow(leaves(leaf_visits), "q long, qv array<double>, bin string, d double")
        return below(asked, levels, width, beam)

    n = min(CALIBRATION, len(known))
    ids = drawn.column("id").to_numpy()[:n] if n else np.zeros(0, np.int64)
    truth = true_neighbours(placed, ids, known[:n], k)
    order = [{leaf: r for r, leaf in enumerate(x for x, _ in tree.best_first(q) if x in filled)} for q in known[:n]]
    leaf_visits = widened([order[i][int(name.partition(".")[0])] for i, name in truth], 1 - (1 - recall) / 2, len(filled) or 1)
    bin_visits, beam = leaf_visits, BEAM
    if levels:
        calibrating = placed.join(F.broadcast(placed.sparkSession.createDataFrame([(int(i),) for i in ids], "id long")), "id", "left_semi")
        wanted = placed.sparkSession.createDataFrame([(int(ids[i]), name) for i, name in truth], "q long, bin string")
        n_bins = sizes.count()
        while True:  # until enough of the true neighbours are within the beam; with all leaves and all bins, all are
            open_ = visited(calibrating, leaf_visits, beam).withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("d", "bin")) - 1)
            met = [r["rank"] for r in wanted.join(open_, ["q", "bin"], "left").select("rank").collect()]  # CALIBRATION * k rows
            if sum(r is not None for r in met) >= recall * len(met) or (beam >= n_bins and leaf_visits >= len(filled)):
                break
            if beam < n_bins:
                beam = min(4 * beam, n_bins)
            else:
                leaf_visits = min(2 * leaf_visits, len(filled))
        bin_visits = widened([math.inf if r is None else r for r in met], recall, beam)
    # nearest first; more than the calibrated visits while they hold fewer than k others
    nearest = Window.partitionBy("q").orderBy("d", "bin")
    asked = visited(placed.where("asks"), leaf_visits, max(beam, bin_visits)).join(sizes, "bin").withColumn("rank", F.row_number().over(nearest)).withColumn("before", F.coalesce(F.sum("n").over(nearest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    short = asked.where((F.col("rank") <= bin_visits) | (F.col("before") <= k)).select("q", "qv", "bin", "n", "rank")
    return placed, short, width, leaf_visits, bin_visits


def candidates(vectors: DataFrame, queries: Column, k: int, key: str, vector: str, sample: int, recall: float) -> DataFrame:
    """``query_id``, ``id``, ``score`` of all rows that may be among the ``k`` nearest found of
    a query. Few more than those leave the tasks, however many bins a query visits."""
    placed, asked, _, _, _ = index(vectors, queries, k, key, vector, sample, recall)
    asked = written(asked)
    # bins of neighbouring leaves lie on one page, so that a query's best leave a page and not a bin; a bin
    # of equal vectors has pages of its own, and a page that many queries visit is read by several tasks
    sizes = written(placed.groupBy("bin").agg(F.count("*").alias("n")).withColumn("leaf", F.substring_index("bin", ".", 1).cast("long")))
    told = sizes.agg(F.sum("n").alias("n"), F.countDistinct("leaf").alias("leaves")).first()
    group = F.expr(f"leaf div {max(1, PAGE * told['leaves'] // (told['n'] or 1))}")
    grouped = sizes.withColumn("leaf", group)
    parts = grouped.groupBy("leaf").agg(F.ceil(F.sum("n") / PAGE).alias("parts"))
    lies = grouped.join(parts, "leaf").select("bin", F.concat_ws(".", "leaf", F.pmod(F.xxhash64("bin"), F.col("parts"))).alias("part"), F.greatest(F.lit(1), F.ceil(F.col("n") / PAGE)).cast("int").alias("pages"))
    lies = written(lies)
    asked = asked.join(lies, "bin").withColumn("page", F.explode(F.sequence(F.lit(0), F.col("pages") - 1)))
    asked = written(asked.groupBy("q", "part", "page").agg(F.first("qv").alias("qv"), F.collect_set("bin").alias("bins"), F.min("rank").alias("rank")))
    dealt = written(asked.groupBy("part", "page").agg(F.ceil(F.count("*") / QUERY_PAGE).cast("int").alias("deals")))
    stored = placed.select("id", "v", "bin").join(lies, "bin").withColumn("page", F.pmod(F.xxhash64("id"), F.col("pages")).cast("int")).drop("pages")
    stored = stored.join(dealt, ["part", "page"]).withColumn("deal", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)))
    stored = written(stored.select("id", "v", "bin", "part", "page", "deal"))
    asked = asked.join(dealt, ["part", "page"]).withColumn("deal", F.pmod(F.xxhash64("q"), F.col("deals")).cast("int")).drop("deals")

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        out_q, out_id, out_d = [], [], []
        if left.num_rows and right.num_rows:
            qs, ids, most_of = left.column("q").to_numpy(), right.column("id").to_numpy(), left.column("most").to_numpy()
            qv, v = matrix(left.column("qv").combine_chunks()), matrix(right.column("v").combine_chunks())
            numbers: dict[str, int] = {}
            bins = np.array([numbers.setdefault(name, len(numbers)) for name in right.column("bin").to_pylist()])
            wanted = left.column("bins").to_pylist()
            for a in range(0, len(qs), 256):
                opened = np.zeros((len(qs[a : a + 256]), len(numbers)), bool)
                for i, names in enumerate(wanted[a : a + 256]):
                    opened[i, [numbers[x] for x in names if x in numbers]] = True
                read = np.flatnonzero(opened.any(0)[bins])  # of bins that none of these queries visits nothing is measured
                if not len(read):
                    continue
                near = np.where(opened[:, bins[read]], distances(qv[a : a + 256], v[read]), np.inf)
                most = np.partition(near, min(k, len(read) - 1), axis=1)[:, min(k, len(read) - 1)]
                slack = 1e-9 * ((qv[a : a + 256] ** 2).sum(1) + (v[read] ** 2).sum(1).max())
                for i in range(len(near)):
                    some = read[np.flatnonzero((near[i] <= most[i] + slack[i]) & (near[i] < np.inf))]
                    some = some[ids[some] != qs[a + i]]
                    d = np.sqrt(((v[some] - qv[a + i]) ** 2).sum(1))
                    some, d = some[d <= most_of[a + i]], d[d <= most_of[a + i]]
                    best = np.lexsort((ids[some], d))[:k]
                    out_q += [qs[a + i]] * len(best)
                    out_id += ids[some[best]].tolist()
                    out_d += d[best].tolist()
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "id": pa.array(out_id, pa.int64()), "score": pa.array(out_d, pa.float64())})

    def met(some: DataFrame) -> DataFrame:
        """The ``k`` nearest of each query on each of its pages, of those that are no farther than ``most``."""
        by = ("part", "page", "deal")
        return some.groupBy(*by).cogroup(stored.groupBy(*by)).applyInArrow(measure, "query_id long, id long, score double")

    # the page of the nearest bin first: the last of the k that are found there says how far the others may be
    home = written(met(asked.where("rank = 1").withColumn("most", F.lit(math.inf))))
    far = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.max("score")).alias("most")).withColumnRenamed("query_id", "q")
    further = asked.where("rank > 1").join(far, "q", "left").withColumn("most", F.coalesce("most", F.lit(math.inf)))
    return home.unionByName(met(further))


def neighbours(vectors: DataFrame, queries: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding", sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """The ``k`` nearest found of each row for which ``queries`` holds, itself
    left out: ``query_id``, ``rank`` (from 1), ``key``, ``score`` (Euclidean
    distance in double precision; ties go to the smaller key).

    Vectors that are null, empty, zero, or hold null or non-finite components
    take no part, nor do those whose length isn't the commonest one (of equally
    common ones the longest), nor rows with a null key. Fewer than ``k``
    candidates: all of them. Equal vectors are candidates each. A repeated key
    is taken as one row, with the vector that sorts first. Empty table: empty result. Other columns are ignored.
    """
    nearest = Window.partitionBy("query_id").orderBy("score", "id")
    found = candidates(vectors, queries, k, key, vector, sample, recall)
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
