"""Hard negatives against brute force, and the ball tree's bounds."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallytree.llm import hard_negatives as h
from tallytree.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, id int, page string"


def brute(rows, shift=True):
    part = {}
    for key, v, label in sorted((r for r in rows if r[0] is not None and r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[1], r[2]), reverse=True):
        label = (label + 1) % 10 if shift and key % 7 == 0 else label
        part[key] = (np.array([math.floor(256 * float(np.float32(x))) for x in v]), label)
    out = []
    for a, (q, label) in part.items():
        if a % 100:
            continue
        score = {k: int(q @ v) for k, (v, _) in part.items() if k != a}
        order = sorted(score, key=lambda k: (-score[k], k))
        for p in [k for k in order if part[k][1] == label][:5]:
            negatives = [k for k in order if part[k][1] != label and 30 * score[p] <= 100 * score[k] <= 90 * score[p]][:10]
            out += [(a, p, i, k, score[p], score[k]) for i, k in enumerate(negatives, 1)]
    return sorted(out)


def made(n, width, seed, labels=10):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, x[i].astype(np.float32).tolist(), int(rng.integers(labels))) for i in range(n)]


def asked(spark, tmp_path, rows):
    spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    return sorted(tuple(r) for r in queries.op11_hard_negatives(spark, str(tmp_path)).collect())


@pytest.mark.parametrize(("page", "block", "drawn"), [(8192, 512, 16), (64, 4, 16), (16, 3, 4)])
def test_negatives_are_those_of_brute_force(spark, tmp_path, monkeypatch, page, block, drawn):
    for name, value in (("PAGE", page), ("BLOCK", block), ("DRAWN", drawn), ("LEAF", 8)):
        monkeypatch.setattr(h, name, value)
    rows = made(700, 12, 1)
    common = rows[100][1]  # many equal vectors: ties by key
    rows += [(1000 + i, common, i % 3) for i in range(300)] + [(2000 + i, [-x for x in common], 5) for i in range(40)]
    got = asked(spark, tmp_path, rows)
    assert got == brute(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(con.sql(queries.ORACLE_SQL["op11_hard_negatives"]).fetchall()) == got


def test_rows_that_take_no_part(spark, tmp_path):
    rows = made(60, 3, 2, 2)
    bad = [(200, None, 1), (300, [1.0, None, 0.0], 1), (400, [1.0, float("nan"), 0.0], 1), (500, [float("inf"), 0.0, 0.0], 1), (600, [1.0, 0.0, 0.0], None), (None, [1.0, 0.0, 0.0], 1), (700, [], 1)]
    odd = [(800, [0.0, 0.0, 0.0], 1), (801, [0.0, 0.0, 0.0], 0), (7, rows[7][1], 9), (7, [-9.0, 0.0, 0.0], 3), (900, [3.0, 0.0, 0.0], 44)]
    got = asked(spark, tmp_path, [*rows, *bad, (1000, [1.0, 0.0], 1), *odd])
    assert got == brute([*rows, *bad, *odd])
    assert {r[0] for r in got} >= {0, 800}
    assert asked(spark, tmp_path / "none", []) == []
    one = spark.createDataFrame([(0, [1e30, 1.0], 1), (1, [1e30, 0.0], 1), (2, [0.5, 1.0], 2)], "vec_id long, embedding array<double>, label int")
    assert [tuple(r) for r in h.hard_negatives(one, F.col("id") == 0, low=0).collect()] == [(0, 1, 1, 2, h.MOST**2, h.MOST * 128 + 256 * 256)]


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.integers(-256, 256, 8) + rng.integers(-9, 9, (64, 8)) for _ in range(40)])
    ids, labels = np.arange(len(x)), rng.integers(0, 3, len(x))
    tree = h.ball_tree(x, ids, labels)
    for node in range(len(tree["lo"])):
        rows = slice(tree["lo"][node], tree["hi"][node])
        assert (np.sqrt(((tree["x"][rows] - tree["centre"][node]) ** 2).sum(1)) <= tree["radius"][node]).all()
        assert tree["mixed"][node] or set(tree["labels"][rows]) == {tree["label"][node]}
    assert sorted(tree["ids"].tolist()) == ids.tolist()
    q = x[:20]
    block = {"q": q, "ids": ids[:20], "labels": labels[:20], "low": np.full((20, 1), h.NONE), "high": np.full((20, 1), -h.NONE), "floor": np.full((20, 1), h.NONE), "floor_id": np.zeros((20, 1), np.int64)}
    seen = []
    real, h.products = h.products, lambda a, b: (seen.append(len(a) * len(b)), real(a, b))[1]
    try:
        r, _, found, score = h.search(tree, block, 5, True)
    finally:
        h.products = real
    for i in range(20):
        s = x @ q[i]
        want = [k for k in np.lexsort((ids, -s)) if k != i and labels[k] == labels[i]][:5]
        assert found[r == i].tolist() == want
        assert score[r == i].tolist() == s[want].tolist()
    assert sum(seen) < 20 * len(x) / 5
