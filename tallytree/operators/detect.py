"""Which samples are abnormally high for which label."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.robust import with_zeros
from ..schema import FLAGS, METHODS

#: Thresholds and what the mixture model stops at.
MAD_THRESHOLD, MAD_SCALE, IQR_MULTIPLIER, GMM_THRESHOLD = 3.5, 1.4826, 1.5, 0.5
ROUNDS, TOLERANCE, LEAST_SIGMA, LEAST_DENSITY, LEAST_MASS, SEPARATION = 200, 1e-6, 1e-8, 1e-300, 1e-10, 3.0


def without_labels(cells: DataFrame, tax_ids: Iterable[int]) -> DataFrame:
    """Leaves out labels known to come with the reagents."""
    ids = list(tax_ids)
    return cells.where(~F.col("tax_id").isin(ids)) if ids else cells


def by_label(by: Iterable[str]) -> WindowSpec:
    """The rows of a label. Its number comes first, as sorts compare that without looking into the rows."""
    return Window.partitionBy("tax_id", *by)


def upto(by: Iterable[str], order: str) -> Column:
    return F.sum("weight").over(by_label(by).orderBy(order).rangeBetween(Window.unboundedPreceding, 0))


def centred(cells: DataFrame, n_samples: int, subtract: bool = True, by: Iterable[str] = ()) -> DataFrame:
    """``by``, tax_id, sample_id, value, weight: with weighted zeros, less the label's
    mean over all samples. Columns ``by`` tell passes apart: a label of one is a label of
    its own. ``upto`` says how many values are not above a row's: taking a mean off leaves
    the order as it is, so that one sort serves the mean and what ``profiled`` reads off."""
    keys = (*by, "tax_id")
    rows = with_zeros(cells, n_samples, *keys)
    rows = rows.withColumn("upto", upto(by, "value"))
    if not subtract:
        return rows
    return rows.withColumn("value", F.col("value") - F.sum("value").over(by_label(by)) / n_samples)


def profiled(rows: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """``centred``'s rows with the statistics of their label beside them: ``med``, ``mad`` (not
    scaled), ``q1``, ``q3``, and ``place``, which is 1 in one row of each label. All are read
    off the rows in order of their values and of their distances to the median: one shuffle
    by label and two sorts, no join, and a label of many samples is sorted on disk, not held
    in memory."""
    whole = by_label(by)
    rows = rows if "upto" in rows.columns else rows.withColumn("upto", upto(by, "value"))
    at = lambda place, value: F.min(F.when(F.col("upto") > place, F.col(value))).over(whole)
    middle = lambda value: (at(F.expr("(n - 1) div 2"), value) + at(F.expr("n div 2"), value)) / 2
    half, even = "greatest(n div 2, 1)", F.expr("n div 2") % 2 == 0
    first, second = F.expr(f"({half} - 1) div 2"), F.when(even, F.expr(f"{half} div 2")).otherwise(F.expr(f"({half} - 1) div 2"))
    above = F.expr(f"n - {half}")
    told = rows.withColumn("n", F.sum("weight").over(whole))
    told = told.withColumns({"med": middle("value"), "q1": (at(first, "value") + at(second, "value")) / 2, "q3": (at(above + first, "value") + at(above + second, "value")) / 2})
    told = told.withColumn("away", F.abs(F.col("value") - F.col("med"))).withColumns({"upto": upto(by, "away"), "place": F.row_number().over(whole.orderBy("away"))})
    return told.withColumn("mad", middle("away")).drop("n", "upto", "away")


def medians(rows: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """``by``, tax_id, med, mad (not scaled): a row a label."""
    told = profiled(rows, by)
    return told.groupBy(*by, "tax_id").agg(F.first("med").alias("med"), F.first("mad").alias("mad"))


def scaled_away() -> F.Column:
    """How many scaled deviations a value is off its label's median; null where that is 0."""
    return F.abs(F.col("value") - F.col("med")) / F.nullif(MAD_SCALE * F.col("mad"), F.lit(0.0))


def over_mad(threshold: float = MAD_THRESHOLD) -> F.Column:
    """Of values over the median by ``threshold`` scaled deviations: how many. A label whose
    median deviation is 0 is skipped; a weighted zero is never over the median."""
    return F.when((scaled_away() > threshold) & (F.col("value") > F.col("med")), scaled_away())


def over_iqr(multiplier: float = IQR_MULTIPLIER) -> F.Column:
    """Of values over 0 and over the upper fence: by how much; a label whose quartiles are equal is skipped."""
    fence = F.col("q3") + multiplier * (F.col("q3") - F.col("q1"))
    return F.when((F.col("q3") > F.col("q1")) & (F.col("value") > fence) & (F.col("value") > 0), F.col("value") - fence)


def density(x: np.ndarray, mu: float, sigma: float) -> np.ndarray:
    if sigma < LEAST_SIGMA:
        return np.full(len(x), LEAST_DENSITY)
    return np.exp(-0.5 * ((x - mu) / sigma) ** 2) / (sigma * math.sqrt(2 * math.pi))


def mixture(x: np.ndarray, w: np.ndarray | None = None) -> tuple[np.ndarray, float, float, float, float, float] | None:
    """Posteriors of the higher component, log likelihood, its mean and spread
    and the other's; None where two components can't be fitted. ``w`` says how often
    each value is there; nothing is repeated for it."""
    found = fitted(x, np.ones(len(x)) if w is None else w)
    return None if found is None else found[:6]


def fitted(x: np.ndarray, w: np.ndarray) -> tuple | None:
    """``mixture``, and (weight, mean, spread) of the higher component and of the other, as the posteriors have them."""
    n, width = int(w.sum()), float(np.ptp(x)) if len(x) else 0.0
    if n < 2 or width < LEAST_SIGMA:
        return None
    order = np.argsort(x, kind="stable")
    s, ws = x[order], w[order]
    lower = np.clip(n // 2 - (np.cumsum(ws) - ws), 0, ws)  # the first n // 2 values
    halves = lower, ws - lower
    mu = [float(h @ s / h.sum()) for h in halves]
    var = [float(h @ (s - m) ** 2 / h.sum()) if h.sum() > 1 else width**2 / 4 for h, m in zip(halves, mu, strict=True)]
    sigma, weight, last = [max(math.sqrt(v), LEAST_SIGMA) for v in var], [0.5, 0.5], -math.inf
    for _ in range(ROUNDS):
        of = list(zip(weight, mu, sigma, strict=True))
        a, b = (weight[k] * density(x, mu[k], sigma[k]) for k in (0, 1))
        total = np.maximum(a + b, LEAST_DENSITY)
        post, likelihood = np.stack([a, b]) / total, float(w @ np.log(total))
        if abs(likelihood - last) < TOLERANCE:
            break
        last = likelihood
        mass = post @ w
        if mass.min() < LEAST_MASS:
            return None
        mu = [float((post[k] * w) @ x / mass[k]) for k in (0, 1)]
        sigma = [max(math.sqrt(float((post[k] * w) @ (x - mu[k]) ** 2 / mass[k])), LEAST_SIGMA) for k in (0, 1)]
        weight = [float(m / n) for m in mass]
    high = 0 if mu[0] > mu[1] else 1
    return post[high], likelihood, mu[high], sigma[high], mu[1 - high], sigma[1 - high], of[high], of[1 - high]


def groups_apart(x: np.ndarray, w: np.ndarray) -> tuple | None:
    """``fitted``, where two groups explain the values better than one, the higher one
    holds two values at least, and they stand apart."""
    found = fitted(x, w)
    if found is None:
        return None
    post, likelihood, high, high_sigma, low, low_sigma = found[:6]
    n, mean = w.sum(), float(w @ x / w.sum())
    sigma = math.sqrt(float(w @ (x - mean) ** 2 / n))
    one = float(w @ np.log(np.maximum(density(x, mean, max(sigma, LEAST_SIGMA)), LEAST_DENSITY)))
    if not -2 * likelihood + 5 * math.log(n) < -2 * one + 2 * math.log(n):
        return None
    if post @ w < 2 or high - low < SEPARATION * max(high_sigma, low_sigma):
        return None
    return found


def two_groups(x: np.ndarray, w: np.ndarray | None = None) -> np.ndarray | None:
    """Posteriors of the higher group of ``groups_apart``."""
    found = groups_apart(x, np.ones(len(x)) if w is None else w)
    return None if found is None else found[0]


PARTS = ("high_weight", "high_mean", "high_sigma", "low_weight", "low_mean", "low_sigma")


def mixtures(rows: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """``by``, tax_id, and the two components (``PARTS``) of each label that has two groups.
    Equal values are counted first; a task goes through its labels in order, and holds the
    different values of one."""
    keys = (*by, "tax_id")
    counted = rows.groupBy(*keys, "value").agg(F.sum("weight").cast("double").alias("weight"))
    kinds = {f.name: f.dataType.simpleString() for f in counted.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fit(columns: list, key: tuple) -> None:
            found = groups_apart(np.concatenate([c[0] for c in columns]), np.concatenate([c[1] for c in columns]))
            if found is not None:
                out.append((*key, *found[6], *found[7]))

        out: list[tuple] = []
        open_, last = [], None
        for b in batches:
            names = list(zip(*(b.column(k).to_pylist() for k in keys), strict=True))
            value, weight = b.column("value").to_numpy(), b.column("weight").to_numpy()
            cuts = [i for i in range(1, len(names)) if names[i] != names[i - 1]]
            for lo, hi in zip([0, *cuts], [*cuts, len(names)], strict=True):
                if lo == hi:
                    continue
                if open_ and names[lo] != last:
                    fit(open_, last)
                    open_ = []
                last = names[lo]
                open_.append((value[lo:hi], weight[lo:hi]))
        if open_:
            fit(open_, last)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip((*keys, *PARTS), r, strict=True)) for r in out], schema=pa.schema([*(b.schema.field(k) for k in keys), *((p, pa.float64()) for p in PARTS)]))

    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"{p} double" for p in PARTS)])
    return counted.repartition(*keys).sortWithinPartitions(*keys, "value").mapInArrow(run, schema)


def in_higher_group() -> F.Column:
    """The chance that a value is of its label's higher group."""
    normal = lambda g: F.col(f"{g}_weight") * F.exp(-0.5 * F.pow((F.col("value") - F.col(f"{g}_mean")) / F.col(f"{g}_sigma"), F.lit(2))) / (F.col(f"{g}_sigma") * math.sqrt(2 * math.pi))
    return normal("high") / F.greatest(normal("high") + normal("low"), F.lit(LEAST_DENSITY))


def search(
    cells: DataFrame, n_samples: int, method: str | tuple[str, ...] = "all", mad_threshold: float = MAD_THRESHOLD, iqr_multiplier: float = IQR_MULTIPLIER, gmm_threshold: float = GMM_THRESHOLD, kitome: Iterable[int] = (), subtract: bool = True, by: Iterable[str] = ()
) -> DataFrame:
    """Everything that is found in one pass over ``cells`` (``by``, tax_id, sample_id,
    value; sparse, null counts as 0), for all passes that ``by`` tells apart: ``by``,
    tax_id, sample_id, value, ``population_median``, ``deviation``, ``method`` of each flag,
    and a row without method and sample of each label, with its ``mad``, ``q1`` and ``q3``."""
    wanted, by = METHODS if method == "all" else (method,) if isinstance(method, str) else method, tuple(by)
    if not set(wanted) <= set(METHODS):
        raise ValueError(f"unknown method {method}; known are {', '.join(METHODS)}, all")
    keys = (*by, "tax_id")
    rows = centred(without_labels(cells, kitome).where("value <> 0"), n_samples, subtract, by)
    told = profiled(rows, by)
    if "gmm" in wanted:
        parts = mixtures(rows, by)
        told = told.join(parts, list(keys), "left")
    found = {"mad": over_mad(mad_threshold), "iqr": over_iqr(iqr_multiplier)}
    if "gmm" in wanted:
        found["gmm"] = F.when(in_higher_group() > gmm_threshold, in_higher_group())
    stored = F.col("sample_id").isNotNull()
    of = lambda name, deviation: F.struct(F.lit(name).cast("string").alias("method"), deviation.cast("double").alias("deviation"))
    hits = [F.when(stored & found[m].isNotNull(), of(m, found[m])) for m in wanted]
    hits.append(F.when(F.col("place") == 1, of(None, F.lit(None))))
    each = told.withColumn("hit", F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())))
    label = F.col("hit.method").isNull()
    only = lambda c, of_label: F.when(label if of_label else ~label, F.col(c)).alias(c)
    return each.select(*keys, only("sample_id", False), only("value", False), F.col("med").alias("population_median"), "hit.deviation", "hit.method", *(only(c, True) for c in ("mad", "q1", "q3")))


def flags(found: DataFrame, names: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The flags of ``search``'s rows, with names."""
    hits = found.where("method IS NOT NULL").join(names.select("tax_id", F.col("name").alias("taxon_name")), "tax_id", "left")
    return hits.withColumn("taxon_name", F.coalesce("taxon_name", F.lit(""))).select(*by, *FLAGS)


def statistics(found: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The labels' rows of ``search``'s: ``by``, tax_id, med, mad, q1, q3."""
    return found.where("method IS NULL").select(*by, "tax_id", F.col("population_median").alias("med"), "mad", "q1", "q3")


def summaries(found: DataFrame, n_samples: int, by: Iterable[str] = ()) -> DataFrame:
    """A row a pass of ``search``'s rows: samples, labels, flags, flagged samples in order,
    and labels without a median deviation and without a spread of quartiles, which the
    first two methods skip."""
    label = F.col("method").isNull()
    return found.groupBy(*by).agg(
        F.lit(n_samples).cast("long").alias("total_samples"), F.count_if(label).alias("total_taxa_analysed"), F.count_if(~label).alias("flagged_count"),
        F.array_join(F.sort_array(F.collect_set("sample_id")), ",").alias("flagged_samples"),
        F.count_if(label & (F.col("mad") == 0)).alias("taxa_skipped_mad_zero"), F.count_if(label & (F.col("q1") == F.col("q3"))).alias("taxa_skipped_iqr_zero"),
    )


def detect(cells: DataFrame, n_samples: int, names: DataFrame, method: str = "all", mad_threshold: float = MAD_THRESHOLD, iqr_multiplier: float = IQR_MULTIPLIER, gmm_threshold: float = GMM_THRESHOLD, kitome: Iterable[int] = (), subtract: bool = True) -> DataFrame:
    """Flags of one method, or of all one below the other. ``cells`` are sparse:
    tax_id, sample_id, value (null counts as 0)."""
    return flags(search(cells, n_samples, method, mad_threshold, iqr_multiplier, gmm_threshold, kitome, subtract), names)


def skipped(cells: DataFrame, n_samples: int, kitome: Iterable[int] = (), subtract: bool = True) -> DataFrame:
    """One row: labels without a median deviation, and without a spread of quartiles,
    which the first two methods skip."""
    return summaries(search(cells, n_samples, "mad", kitome=kitome, subtract=subtract), n_samples).select("taxa_skipped_mad_zero", "taxa_skipped_iqr_zero")


def qc_summary(flags: DataFrame, cells: DataFrame, n_samples: int) -> DataFrame:
    """One row: samples, labels, flags, and the flagged samples in order."""
    found = flags.agg(F.count("*").alias("flagged_count"), F.array_join(F.sort_array(F.collect_set("sample_id")), ",").alias("flagged_samples"))
    return cells.agg(F.lit(n_samples).cast("long").alias("total_samples"), F.countDistinct("tax_id").alias("total_taxa_analysed")).join(F.broadcast(found))
