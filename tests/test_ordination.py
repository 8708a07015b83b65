"""Trees and coordinates made on executors against those made by hand."""

import numpy as np
import pytest

from tallytree.operators import ordination

ITEM = "item string"
PAIR = "a string, b string, distance double"


def table(spark, names, d, sparse=False):
    rows = [(names[i], names[j], float(d[i, j])) for i in range(len(names)) for j in range(i + 1, len(names)) if not sparse or d[i, j] < 1]
    return spark.createDataFrame([(x,) for x in names], ITEM), spark.createDataFrame(rows, PAIR)


@pytest.mark.parametrize("method", ["average", "single", "ward"])
@pytest.mark.parametrize("sparse", [False, True])
def test_merges_are_those_of_one_at_a_time(spark, method, sparse):
    rng = np.random.default_rng(3)
    points = rng.normal(size=(12, 3)) + (np.arange(12) % 3)[:, None] * 2
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    d = d / d.max() * (1.7 if sparse else 0.99)
    if sparse:  # what is 1 or more apart is 1 apart, and has no row
        d = np.minimum(d, 1.0)
    names = [f"s{i:02d}" for i in range(12)]
    merges, leaves = ordination.linkage(*table(spark, names, d, sparse), method)
    got = sorted(r["height"] for r in merges.collect())
    order, plain = ordination.cluster(d, method)
    assert np.allclose(got, sorted(m[2] for m in plain))
    rows = sorted(leaves.collect(), key=lambda r: r["place"])
    assert [r["place"] for r in rows] == list(range(12))
    assert np.allclose(sorted(r["height"] for r in rows)[1:], got)
    size = {r["b"]: r["size"] for r in merges.collect()}
    assert max(size.values()) == 12
    if not sparse:  # the members of each merge stand side by side
        place = {r["item"]: r["place"] for r in rows}
        tree = {i: [names[i]] for i in range(12)}
        for k, (a, b, _, _) in enumerate(plain, 12):
            tree[k] = tree[a] + tree[b]
            at = sorted(place[x] for x in tree[k])
            assert at == list(range(at[0], at[0] + len(at)))


def test_trees_of_few_items_and_of_unlike_ones(spark):
    items, none = spark.createDataFrame([("b",), ("a",), ("a",), ("c",)], ITEM), spark.createDataFrame([], PAIR)
    merges, leaves = ordination.linkage(items, none)
    assert sorted(tuple(r) for r in merges.collect()) == [("a", "b", 1.0, 2), ("a", "c", 1.0, 3)]
    assert sorted(tuple(r) for r in leaves.collect()) == [("a", 0, 0.0), ("b", 1, 1.0), ("c", 2, 1.0)]
    assert ordination.linkage(items.limit(0), none)[1].count() == 0
    with pytest.raises(ValueError, match="linkage"):
        ordination.linkage(items, none, "median")


@pytest.mark.parametrize("sparse", [False, True])
def test_coordinates_are_those_of_the_whole_matrix(spark, sparse):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(14, 6)) * np.array([3, 2, 1, 0.5, 0.3, 0.2])
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    d = np.minimum(d / d.max() * (1.6 if sparse else 0.99), 1.0)
    names = [f"s{i:02d}" for i in range(14)]
    found, shares = ordination.coordinates(*table(spark, names, d, sparse))
    want, explained = ordination.principal_coordinates(d)
    got = np.array([[r["x0"], r["x1"]] for r in found.orderBy("item").collect()])
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
    assert np.allclose(shares, explained, atol=1e-9)
    assert (got[np.abs(got).argmax(0), [0, 1]] > 0).all()


def test_coordinates_need_three_items(spark):
    items, pairs = table(spark, ["a", "b"], np.array([[0, 0.5], [0.5, 0]]))
    found, shares = ordination.coordinates(items, pairs)
    assert found.count() == 0
    assert shares == [0.0, 0.0]
    same = ordination.coordinates(*table(spark, ["a", "b", "c"], np.zeros((3, 3))))[0]
    assert all(abs(r["x0"]) < 1e-9 for r in same.collect())


def test_heat_map_cells_stand_in_both_orders(spark):
    cells = spark.createDataFrame([("s1", 1, 5.0), ("s2", 1, 6.0), ("s2", 9, 1.0), ("s3", 2, 7.0)], "sample_id string, tax_id long, value double")
    rows = spark.createDataFrame([(2, 0), (1, 1)], "item long, place long")
    columns = spark.createDataFrame([("s2", 0), ("s1", 1), ("s3", 2)], "item string, place long")
    assert sorted(tuple(r) for r in ordination.heat_map(cells, rows, columns).collect()) == [(0, 2, 2, "s3", 7.0), (1, 0, 1, "s2", 6.0), (1, 1, 1, "s1", 5.0)]
