"""Order statistics, detection and ordination against values worked out by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallytree.functions import robust
from tallytree.operators import detect, ordination


def weighted(spark, values):
    return spark.createDataFrame([(1, None, float(v), 1) for v in values], "tax_id long, sample_id string, value double, weight long")


@pytest.mark.parametrize(("values", "q1", "q3"), [([1, 2, 3, 4, 5], 1.5, 4.5), ([1, 2, 3, 4], 1.5, 3.5), ([7], 7.0, 7.0), ([1, 2], 1.0, 2.0)])
def test_quartiles_leave_the_middle_out(spark, values, q1, q3):
    assert [tuple(r) for r in robust.quartiles(weighted(spark, values), "tax_id").collect()] == [(1, q1, q3)]


@pytest.mark.parametrize(("values", "median", "mad"), [([3, 1, 2], 2.0, 1.0), ([4, 1, 3, 2], 2.5, 1.0), ([5, 5, 5, 5], 5.0, 0.0), ([1, 2, 3, 4, 5], 3.0, 1.0)])
def test_medians(spark, values, median, mad):
    assert [tuple(r) for r in detect.medians(weighted(spark, values)).collect()] == [(1, median, mad)]


def test_weighted_zeros_stand_for_missing_cells(spark):
    cells = spark.createDataFrame([(1, "a", 4.0), (1, "b", 2.0)], "tax_id long, sample_id string, value double")
    rows = robust.with_zeros(cells, 5, "tax_id")
    assert [tuple(r) for r in detect.medians(rows).collect()] == [(1, 0.0, 0.0)]
    assert [tuple(r) for r in robust.quartiles(rows, "tax_id").collect()] == [(1, 0.0, 3.0)]


def test_summary_and_histogram(spark):
    rows = spark.createDataFrame([(1.0,), (None,), (2.0,), (float("nan"),), (3.0,)], "v double")
    got = rows.agg(*robust.summary("v")).first()
    assert (got["n"], got["median"], got["min"], got["max"]) == (3, 2.0, 1.0, 3.0)
    ten = spark.createDataFrame([(float(10**k),) for k in range(4)] + [(0.0,)], "v double")
    assert [r["n"] for r in robust.histogram(ten, "v", 4, log=True).orderBy("bin").collect()] == [1, 1, 1, 1]
    assert robust.histogram(ten.limit(0), "v", 3).agg(F.sum("n")).first()[0] == 0


CONTAMINATED = {1279: [100, 102, 99, 101, 100, 105], 562: [50, 51, 49, 50, 52, 5000], 0: [800, 810, 795, 805, 798, 803]}
SAMPLES = ["clean_01", "clean_02", "clean_03", "clean_04", "clean_05", "contam_01"]


def cohort(spark):
    cells = spark.createDataFrame([(t, s, float(v)) for t, vs in CONTAMINATED.items() for s, v in zip(SAMPLES, vs, strict=True)], "tax_id long, sample_id string, value double")
    return cells, spark.createDataFrame([(562, "Escherichia coli")], "tax_id long, name string")


def test_the_contaminated_sample_is_flagged_by_mad(spark):
    cells, names = cohort(spark)
    (row,) = detect.detect(cells, 6, names, "mad").collect()
    assert (row["sample_id"], row["tax_id"], row["taxon_name"]) == ("contam_01", 562, "Escherichia coli")
    assert [round(row[c], 4) for c in ("value", "population_median", "deviation")] == [4124.6667, -824.8333, 3338.392]


def test_unknown_method_and_excluded_labels(spark):
    cells, names = cohort(spark)
    with pytest.raises(ValueError, match="unknown method"):
        detect.detect(cells, 6, names, "zscore")
    assert detect.detect(cells, 6, names, "mad", kitome=[562]).count() == 0


def test_mixture_finds_the_majority_when_it_is_contaminated():
    x = np.array([50.0 + i % 5 for i in range(5)] + [5000.0 + i for i in range(15)])
    post = detect.two_groups(x)
    assert (post[5:] > 0.5).all()
    assert (post[:5] < 0.5).all()
    assert detect.two_groups(np.full(6, 3.0)) is None
    assert detect.two_groups(np.array([1.0])) is None


def test_clusters_and_coordinates():
    points = np.array([0.0, 1, 10, 11])
    d = np.abs(points[:, None] - points[None, :])
    order, merges = ordination.cluster(d, "average")
    assert [round(m[2], 6) for m in merges] == [1, 1, 10]
    assert {frozenset(order[:2]), frozenset(order[2:])} == {frozenset({0, 1}), frozenset({2, 3})}
    assert [m[2] for m in ordination.cluster(np.array([[0, 1, 10], [1, 0, 5], [10, 5, 0.0]]), "single")[1]] == [1, 5]
    corners = np.array([[0, 0], [0, 10], [10, 0], [10, 10.0]])
    square = np.sqrt(((corners[:, None] - corners[None]) ** 2).sum(2))
    coords, shares = ordination.principal_coordinates(square)
    assert np.allclose(np.sqrt(((coords[:, None] - coords[None]) ** 2).sum(2)), square)
    assert shares.sum() == pytest.approx(1)
    assert not ordination.principal_coordinates(np.zeros((3, 3)))[0].any()
    with pytest.raises(ValueError, match="linkage"):
        ordination.cluster(d, "median")


def test_distances(spark):
    cells = spark.createDataFrame([("a", 1, 2.0), ("b", 1, 2.0), ("c", 2, 5.0), ("c", 1, 1.0)], "sample_id string, tax_id long, value double")
    got = {(r["a"], r["b"]): (r["bray_curtis"], r["jaccard"]) for r in ordination.pairwise(cells).collect()}
    assert got == {("a", "b"): (0.0, 0.0), ("a", "c"): (0.75, 0.5), ("b", "c"): (0.75, 0.5)}


def test_detection_sorts_twice(spark):
    """By value for mean, median and quartiles, by distance for the deviation."""
    cells = spark.createDataFrame([("a", 1, "S1", 5.0), ("a", 1, "S2", 7.0)], "pass string, tax_id long, sample_id string, value double")
    plan = detect.search(cells, 3, ("mad", "iqr"), by=("pass",))._jdf.queryExecution().executedPlan().toString()
    assert plan.count(" Sort [") == 2
