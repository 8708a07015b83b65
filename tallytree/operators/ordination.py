"""Distances between samples, and what is drawn from them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import dropped, kept

#: Blocks of samples in which a label's pairs are made.
BLOCKS = 8


def pairwise(cells: DataFrame) -> DataFrame:
    """``a``, ``b`` (a < b), ``bray_curtis``, ``jaccard`` of all pairs of samples
    that share a label; those that share none are 1 apart and left out. Joins by
    label: sum|x - y| = sum x + sum y - 2 sum min(x, y)."""
    v = cells.where("value > 0").select("sample_id", "tax_id", F.col("value").cast("double").alias("value"))
    size = v.groupBy("sample_id").agg(F.sum("value").alias("total"), F.count("*").alias("present"))
    # a label that all samples have is dealt to BLOCKS * BLOCKS tasks
    block, every = F.pmod(F.xxhash64("sample_id"), F.lit(BLOCKS)), F.sequence(F.lit(0).cast("long"), F.lit(BLOCKS - 1).cast("long"))
    one, other = v.withColumn("i", block).withColumn("j", F.explode(every)), v.withColumn("j", block).withColumn("i", F.explode(every))
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("tax_id", "i", "j")]
    pairs = one.alias("x").join(other.alias("y"), same[0] & same[1] & same[2] & (F.col("x.sample_id") < F.col("y.sample_id")))
    shared = pairs.groupBy(F.col("x.sample_id").alias("a"), F.col("y.sample_id").alias("b")).agg(F.sum(F.least("x.value", "y.value")).alias("least"), F.count("*").alias("both"))
    out = shared.join(size.select(F.col("sample_id").alias("a"), F.col("total").alias("ta"), F.col("present").alias("pa")), "a").join(size.select(F.col("sample_id").alias("b"), F.col("total").alias("tb"), F.col("present").alias("pb")), "b")
    total = F.col("ta") + F.col("tb")
    return out.select("a", "b", ((total - 2 * F.col("least")) / total).alias("bray_curtis"), (1 - F.col("both") / (F.col("pa") + F.col("pb") - F.col("both"))).alias("jaccard"))


def square(pairs: DataFrame, samples: list[str], measure: str = "bray_curtis") -> np.ndarray:
    """The distances of a capped list of samples, as a matrix. Pairs without a row are 1 apart."""
    place = {s: i for i, s in enumerate(samples)}
    d = np.ones((len(samples), len(samples)))
    np.fill_diagonal(d, 0.0)
    wanted = pairs.where(F.col("a").isin(samples) & F.col("b").isin(samples))
    for r in wanted.select("a", "b", measure).toArrow().to_pylist():
        d[place[r["a"]], place[r["b"]]] = d[place[r["b"]], place[r["a"]]] = r[measure]
    return d


def cluster(d: np.ndarray, method: str = "average") -> tuple[list[int], list[tuple[int, int, float, int]]]:
    """Leaf order and merges (one, other, distance, size) of hierarchical
    clustering by average, single or ward linkage; ties go to the first pair."""
    if method not in ("average", "single", "ward"):
        raise ValueError(f"unknown linkage {method}")
    n = len(d)
    ids, sizes, trees = list(range(n)), {i: 1 for i in range(n)}, {i: [i] for i in range(n)}
    d, merges = d.astype(float).copy(), []
    np.fill_diagonal(d, np.inf)
    while len(ids) > 1:
        upper = np.where(np.triu(np.ones(d.shape, bool), 1), d, np.inf)
        i, j = np.unravel_index(int(upper.argmin()), d.shape)
        at, a, b = float(d[i, j]), sizes[ids[i]], sizes[ids[j]]
        if method == "single":
            row = np.minimum(d[i], d[j])
        elif method == "average":
            row = (a * d[i] + b * d[j]) / (a + b)
        else:
            c = np.array([sizes[k] for k in ids])
            row = np.sqrt(np.maximum(((a + c) * d[i] ** 2 + (b + c) * d[j] ** 2 - c * at**2) / (a + b + c), 0))
        new = n + len(merges)
        merges.append((ids[i], ids[j], at, a + b))
        sizes[new], trees[new] = a + b, trees[ids[i]] + trees[ids[j]]
        keep = [k for k in range(len(ids)) if k not in (i, j)]
        side = row[keep]
        d = np.block([[d[np.ix_(keep, keep)], side[:, None]], [side[None, :], np.full((1, 1), np.inf)]])
        ids = [ids[k] for k in keep] + [new]
    return (trees[ids[0]] if ids else []), merges


def joining_heights(order: list[int], merges: list[tuple[int, int, float, int]]) -> list[float]:
    """Of each leaf in order, the distance of the merge that joins it with the leaf before; of the first, 0."""
    tree: dict[int, list[int]] = {k: [k] for k in order}
    out = dict.fromkeys(order, 0.0)
    for new, (a, b, at, _) in enumerate(merges, len(order)):
        out[tree[b][0]] = at  # the later tree's first leaf stands next to the earlier tree's last
        tree[new] = tree.pop(a) + tree.pop(b)
    return [out[k] for k in order]


#: How two clusters' distance comes from the ``pairs`` of their members that are less than 1
#: apart (their number, the sum, sum of squares and least of distances), the number ``n`` of
#: all, and for ward from the sums of squares within either (``ia``, ``ib``) and their sizes.
LINKAGES = ("average", "single", "ward")


def between(method: str) -> Column:
    n, missing = F.col("na") * F.col("nb"), F.col("na") * F.col("nb") - F.col("pairs")
    if method == "single":
        return F.col("least")
    if method == "average":
        return (F.col("sum") + missing) / n
    if method != "ward":
        raise ValueError(f"unknown linkage {method}; known are {', '.join(LINKAGES)}")
    apart = (F.col("squares") + missing) / n - F.col("ia") / (F.col("na") * F.col("na")) - F.col("ib") / (F.col("nb") * F.col("nb"))
    return F.sqrt(F.greatest(2 * n / (F.col("na") + F.col("nb")) * apart, F.lit(0.0)))


def linkage(items: DataFrame, pairs: DataFrame, method: str = "average") -> tuple[DataFrame, DataFrame]:
    """Hierarchical clustering of ``items`` (item) by their ``pairs`` (a, b, distance; a
    before b, each once; pairs without a row are 1 apart): merges (``a``, ``b``,
    ``height``, ``size``) and leaves (``item``, ``place``, ``height``).

    All pairs of clusters that are nearest to each other merge at once, which for these
    linkages gives the same tree as one merge after another. A cluster is called by its
    first item, and stands where that one is; of ties the first pair counts. The pair table
    stays as sparse as it was given: a pair of clusters keeps sums over its members.
    A leaf's ``height`` is that of the merge that joins it with the leaf before it (0 for the
    first). Everything but the loop is on executors; a round is a few joins of the pair table.
    """
    between(method)
    v = F.col("distance").cast("double")
    table = kept(pairs.select("a", "b", F.lit(1).cast("long").alias("pairs"), v.alias("sum"), (v * v).alias("squares"), v.alias("least")))
    one = F.lit(1).cast("long")
    clusters = kept(items.select(F.col("item").alias("c"), one.alias("n"), F.lit(0.0).alias("inner")).distinct())
    leaves = kept(clusters.select(F.col("c").alias("item"), "c", F.lit(0).cast("long").alias("place")))
    merges: list[DataFrame] = []
    side = lambda c, p: clusters.select(F.col("c").alias(c), F.col("n").alias(f"n{p}"), F.col("inner").alias(f"i{p}"))
    while True:
        known = table.join(side("a", "a"), "a").join(side("b", "b"), "b").withColumn("height", between(method))
        best = F.min(F.struct("height", "a", "b")).alias("best")
        nearest = known.select(F.explode(F.array("a", "b")).alias("c"), "height", "a", "b").groupBy("c").agg(best)
        both = nearest.groupBy("best").agg(F.count("*").alias("sides")).where("sides = 2").select("best.*")
        found = kept(both.join(known.select("a", "b", "na", "nb", "ia", "ib", "squares", "pairs"), ["a", "b"]))
        if found.isEmpty():
            break
        merges.append(found.select("a", "b", "height", (F.col("na") + F.col("nb")).alias("size")))
        inside = F.col("ia") + F.col("ib") + F.col("squares") + F.col("na") * F.col("nb") - F.col("pairs")
        new = found.select(F.col("a").alias("to"), F.col("b").alias("gone"), (F.col("na") + F.col("nb")).alias("size"), inside.alias("within"), F.col("na").alias("ahead"))
        leaves, old = kept(leaves.join(new, leaves["c"] == new["gone"], "left").select("item", F.coalesce("to", "c").alias("c"), (F.col("place") + F.coalesce("ahead", F.lit(0))).alias("place"))), leaves
        dropped(old)
        to = new.select("gone", "to")
        ends = table.join(to.withColumnsRenamed({"gone": "a", "to": "ta"}), "a", "left").join(to.withColumnsRenamed({"gone": "b", "to": "tb"}), "b", "left")
        ends = ends.select(F.coalesce("ta", "a").alias("x"), F.coalesce("tb", "b").alias("y"), "pairs", "sum", "squares", "least").where("x <> y")
        sums = [F.sum(c).alias(c) for c in ("pairs", "sum", "squares")]
        table, old = kept(ends.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(*sums, F.min("least").alias("least"))), table
        dropped(old)
        grown = clusters.join(new.select("gone"), F.col("c") == F.col("gone"), "left_anti").join(new.select(F.col("to").alias("c"), "size", "within"), "c", "left")
        clusters, old = kept(grown.select("c", F.coalesce("size", "n").alias("n"), F.coalesce("within", "inner").alias("inner"))), clusters
        dropped(old)
    # clusters that share nothing are 1 apart: one after the other, in order
    apart = [tuple(r) for r in clusters.orderBy("c").collect()]  # as many as there are parts without any pair between them
    rest, ahead, first = [], 0, apart[0] if apart else None
    within = first[2] if first else 0.0
    for c, n, inner in apart[1:]:
        ahead += apart[len(rest)][1]
        height = 1.0 if method != "ward" else float(np.sqrt(max(2 * ahead * n / (ahead + n) * (1 - within / ahead**2 - inner / n**2), 0)))
        within += inner + ahead * n
        rest.append((first[0], c, height, ahead + n, ahead))
    kinds = dict(clusters.dtypes)["c"]
    late = items.sparkSession.createDataFrame(rest, f"a {kinds}, b {kinds}, height double, size long, ahead long")
    out = late.drop("ahead")
    for m in merges:
        out = out.unionByName(m)
    out = kept(out)
    shift = leaves.join(late.select(F.col("b").alias("c"), "ahead"), "c", "left").select("item", (F.col("place") + F.coalesce("ahead", F.lit(0))).alias("place"))
    joined = shift.join(out.select(F.col("b").alias("item"), "height"), "item", "left").select("item", "place", F.coalesce("height", F.lit(0.0)).alias("height"))
    return out, joined


def heat_map(cells: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """``row``, ``column``, ``tax_id``, ``sample_id``, ``value`` of cells (sample_id, tax_id,
    value) whose label is a leaf of ``rows`` and whose sample one of ``columns`` (item,
    place), in the order of both trees; cells that aren't there are 0 and left out."""
    down = rows.select(F.col("item").alias("tax_id"), F.col("place").cast("int").alias("row"))
    across = columns.select(F.col("item").alias("sample_id"), F.col("place").cast("int").alias("column"))
    return cells.join(down, "tax_id").join(across, "sample_id").select("row", "column", "tax_id", "sample_id", "value")


#: Steps of the Krylov space in which coordinates are sought, at most.
STEPS = 60


def coordinates(items: DataFrame, pairs: DataFrame, axes: int = 2, steps: int = STEPS) -> tuple[DataFrame, list[float]]:
    """Principal coordinates of ``items`` (item) by ``pairs`` (a, b, distance; the others are
    1 apart): ``item`` and ``x0``, ``x1``, ... for each of ``axes``, and the share of each.

    The centred squared distances B are never formed: B v = -1/2 J (D (J v)) is a join of the
    sparse pair table with v, and its ones beyond the table are a sum. From one vector Lanczos'
    recurrence builds an orthogonal basis, a column a step in a table of items; the small
    tridiagonal matrix's eigenvectors give the coordinates. The largest component of an axis
    is positive. Under 3 items say nothing: no rows.
    """
    n = items.count()
    if n < 3:
        kind = dict(items.dtypes)["item"]
        return items.sparkSession.createDataFrame([], ", ".join([f"item {kind}", *(f"x{k} double" for k in range(axes))])), [0.0] * axes
    square = F.col("distance").cast("double") * F.col("distance").cast("double") - 1
    ends = pairs.select("a", "b", square.alias("w"))
    table = kept(ends.unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")))
    # the trace of B is a sum over all pairs
    trace = ((table.agg(F.sum("w")).first()[0] or 0.0) + n * (n - 1)) / (2 * n)
    seed = F.pmod(F.xxhash64("item"), F.lit(1 << 20)) / float(1 << 20) - 0.5
    basis = kept(items.select("item", seed.alias("v")))
    total, squares = basis.agg(F.sum("v"), F.sum(F.col("v") * F.col("v"))).first()
    norm = float(np.sqrt(squares - total * total / n))
    basis, old = kept(basis.select("item", F.array((F.col("v") - total / n) / norm).alias("q"))), basis
    dropped(old)
    alphas, betas = [], []
    while len(alphas) < min(steps, n - 1):
        last = F.element_at("q", -1)
        v = basis.select(F.col("item").alias("b"), last.alias("v"))
        met = table.join(v, "b").groupBy(F.col("a").alias("item")).agg(F.sum(F.col("w") * F.col("v")).alias("y"))
        # v is centred, so D v is the table's part less v itself
        y = kept(basis.join(met, "item", "left").select("item", "q", (-0.5 * (F.coalesce("y", F.lit(0.0)) - last)).alias("y")))
        width = len(alphas) + 1
        dots = y.agg(F.sum("y"), *(F.sum(F.col("q")[i] * F.col("y")) for i in range(width))).first()
        alphas.append(float(dots[width]))
        # against every earlier column, twice: rounding must not bring them back
        less = lambda c, d: (F.col(c) - d[0] / n - sum((F.col("q")[i] * d[i + 1] for i in range(width)), F.lit(0.0)))
        y2 = kept(y.select("item", "q", less("y", dots).alias("y")))
        again = y2.agg(F.sum("y"), *(F.sum(F.col("q")[i] * F.col("y")) for i in range(width))).first()
        y3 = kept(y2.select("item", "q", less("y", again).alias("y")))
        beta = float(np.sqrt(y3.agg(F.sum(F.col("y") * F.col("y"))).first()[0]))
        if beta < 1e-12 * max(1.0, abs(alphas[0])) or len(alphas) == min(steps, n - 1):
            dropped(y, y2, y3)
            break
        betas.append(beta)
        basis, old = kept(y3.select("item", F.concat("q", F.array(F.col("y") / beta)).alias("q"))), basis
        dropped(old, y, y2, y3)
    m = len(alphas)
    values, vectors = np.linalg.eigh(np.diag(alphas) + np.diag(betas[: m - 1], 1) + np.diag(betas[: m - 1], -1))
    first = np.argsort(-values)[:axes]
    lam = [float(values[k]) if values[k] > 1e-12 else 0.0 for k in first]
    x = [sum((F.col("q")[i] * float(vectors[i, k] * np.sqrt(at)) for i in range(m)), F.lit(0.0)).alias(f"x{j}") for j, (k, at) in enumerate(zip(first, lam, strict=True))]
    x += [F.lit(0.0).alias(f"x{j}") for j in range(len(first), axes)]
    out = kept(basis.select("item", *x))
    ends = out.agg(*(F.max_by(f"x{j}", F.struct(F.round(F.abs(f"x{j}"), 9), "item")) for j in range(axes))).first()
    dropped(table, basis)
    signed = out.select("item", *((F.col(f"x{j}") * (-1.0 if (ends[j] or 0.0) < 0 else 1.0)).alias(f"x{j}") for j in range(axes)))
    return signed, [*(at / trace if trace > 0 else 0.0 for at in lam), *[0.0] * (axes - len(lam))]


def principal_coordinates(d: np.ndarray, axes: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and explained shares: eigenvectors of the centred squared distances."""
    n = len(d)
    if n == 0:
        return np.zeros((0, axes)), np.zeros(axes)
    centre = np.eye(n) - 1 / n
    b = -0.5 * centre @ (d**2) @ centre
    values, vectors = np.linalg.eigh((b + b.T) / 2)
    first = np.argsort(-values)[:axes]
    lam = np.maximum(values[first], 0)
    trace = float(np.trace(b))
    coords = np.zeros((n, axes))
    coords[:, : len(first)] = vectors[:, first] * np.sqrt(lam)
    shares = np.zeros(axes)
    shares[: len(first)] = np.where(lam > 0, lam / trace, 0.0) if trace > 0 else 0.0
    return coords, shares
