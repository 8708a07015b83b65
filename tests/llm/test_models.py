"""Learned operators by held-out accuracy, neighbours by recall against brute force."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallytree.llm import neighbours, quality, queries, toxicity
from tallytree.llm.common import table

DATA, LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"
given = pytest.mark.skipif(not os.path.exists(DATA), reason="the given tables aren't here")
SCHEMA = "doc_id long, text string, score double, y int"


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1
    n = y.sum()
    return (order[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def scored(spark, query, label, data=DATA):
    rows = query(spark, data).join(table(spark, data, "labels"), "doc_id").where("held_out").select("score", "predicted", label).collect()
    return np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])


@given
def test_quality_of_what_was_held_out(spark):
    score, predicted, y = scored(spark, queries.op4_quality, "quality")
    assert auc(score, y) > 0.97
    assert predicted[y == 1].mean() > 0.97
    assert ((score >= 0) & (score <= 1)).all()


@given
def test_toxicity_of_what_was_held_out(spark):
    """On the larger tables: of the small ones' held-out rows six are toxic, too few to measure by."""
    score, predicted, y = scored(spark, queries.op10_toxicity, "toxic", LARGER)
    assert y.sum() > 90
    assert auc(score, y) > 0.95
    assert predicted[y == 0].mean() < 0.05
    assert predicted[y == 1].mean() > 0.8


def made(spark, n=300):
    texts = [" ".join(["calm words here"] * (1 + i % 5)) + (". you vile clot! more" if i % 4 == 0 else ". fine.") for i in range(n)]
    docs = spark.createDataFrame([(i, t, 0.0, 9) for i, t in enumerate(texts)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 4 == 0)) for i in range(n)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    return docs, labels


ODD = [(1, None, 0.0, 1), (2, "", 0.0, 1), (3, "  \n", 0.0, 1), (None, "calm", 0.0, 1), (4, "you vile clot! " * 9000, 0.0, 1), (4, "you vile clot! " * 9000, 0.0, 1)]


def test_offending_sentences_are_found(spark):
    docs, labels = made(spark)
    model = toxicity.fit_toxicity(docs, labels)
    got = toxicity.toxicity_scores(docs, model).join(docs, "doc_id").select("text", "offending").collect()
    for text, spans in got:
        assert [text.encode()[s["start"] : s["end"]].decode().strip() for s in spans] == (["you vile clot"] if "vile" in text else [])
    odd = toxicity.toxicity_scores(spark.createDataFrame(ODD, SCHEMA), model).collect()
    assert len(odd) == len(ODD)
    assert all(0 <= r["score"] <= 1 for r in odd)
    assert {r["score"] for r in odd if r["doc_id"] in (1, 2)} == {0.0}


def test_scores_without_labels_and_of_odd_texts(spark):
    docs, labels = made(spark)
    odd = spark.createDataFrame(ODD, SCHEMA)
    for none in (labels.limit(0), labels.where("quality = 1"), labels.where(quality.held_out())):
        scores = {r["score"] for r in quality.quality_scores(odd, quality.fit_quality(docs, none)).collect()}
        assert len(scores) == 1
        assert 0 < toxicity.toxicity_scores(odd, toxicity.fit_toxicity(docs, none.where("toxic = 0"))).agg(F.max("score")).first()[0] <= 1
    model = quality.fit_quality(docs, labels)
    assert quality.quality_scores(odd, model).count() == len(ODD)
    assert quality.quality_scores(odd.limit(0), model).count() == 0
    kept = quality.quality_scores(odd.drop("score"), model, keep=("doc_id", "text", "y"))
    assert kept.columns == ["doc_id", "text", "y", "score"]


def test_trees_split_what_can_be_split():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 1] > 0.3) ^ (x[:, 3] < 0)).astype(float)
    model = quality.fit_trees(x[:1500], y[:1500])
    assert auc(model.scores(x[1500:]), y[1500:]) > 0.98
    assert model.scores(np.zeros((0, 5))).shape == (0,)


def brute(ids, x, k, step):
    out = {}
    for i in np.flatnonzero(ids % step == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(1))
        out[int(ids[i])] = [int(ids[j]) for j in np.lexsort((ids, d)) if j != i][:k]
    return out


def test_few_candidates_leave_the_bins_of_a_query(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 64)
    monkeypatch.setattr(neighbours, "PAGE", 512)
    x = np.random.default_rng(5).normal(size=(6000, 32))  # without clusters, so that a query visits most bins
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    args = frame, F.col("vec_id") % 100 == 0, 10, "vec_id", "embedding", 1500, 0.97
    visits = neighbours.index(*args)[1].count()
    found = neighbours.candidates(*args)
    rows = found.collect()
    assert visits > 60 * 40 and len(rows) < min(60 * 100, visits)  # before: ten of each bin visited
    hit = 0
    for q in range(0, 6000, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        near = sorted((r["score"], r["id"]) for r in rows if r["query_id"] == q)[:10]
        assert len(near) == 10 and all(s == d[i] for s, i in near)
        hit += len({i for _, i in near} & set(np.argsort(d)[:10].tolist()))
    assert hit >= 0.9 * 600


def test_neighbours_recall_and_ties(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 1, (400, 16)) for c in rng.normal(0, 2, (5, 16))]).astype(np.float32).astype(float)
    x[500:620] = x[500]  # equal vectors
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<float>, id int")
    got = {}
    for r in neighbours.neighbours(rows, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
        assert r["score"] == np.sqrt(((x[r["vec_id"]] - x[r["query_id"]]) ** 2).sum())
    want = brute(np.arange(len(x)), x, 10, 20)
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    assert got[500] == list(range(501, 511))


def test_the_tree_prunes_and_still_finds(spark, monkeypatch):
    """Many bins, two levels of them: a query reads under a fifth and finds nine in ten."""
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 128)
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.6, (300, 16)) for c in rng.normal(0, 1.2, (200, 16))])
    x[1000:1300] = x[1000]  # a bin that can't be split
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 16).cast(pa.list_(pa.float64()))}))
    placed, asked, _, _, _ = neighbours.index(frame, F.col("vec_id") % 100 == 0, 10, "vec_id", "embedding", 4000, 0.97)
    bins = placed.select("bin").distinct().count()
    assert placed.where("bin LIKE '%.%'").count() > 0
    assert bins > 400
    assert asked.groupBy("q").count().agg(F.avg("count")).first()[0] < bins / 5
    got = {}
    for r in neighbours.neighbours(frame, F.col("vec_id") % 100 == 0, sample=4000).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = brute(np.arange(len(x)), x, 10, 100)
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9
    assert got[1000] == list(range(1001, 1011))


def test_a_narrow_beam_widens_until_recall_is_met(spark, monkeypatch):
    """Directions without clusters: what calibration needs is more than the first beam holds."""
    monkeypatch.setattr(neighbours, "LEAF_ROWS", 64)
    monkeypatch.setattr(neighbours, "BEAM", 2)
    x = np.random.default_rng(4).normal(size=(6000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(len(x)), "embedding": pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), 24).cast(pa.list_(pa.float64()))}))
    got = {}
    for r in neighbours.neighbours(frame, F.col("vec_id") % 100 == 0, sample=1000).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    want = brute(np.arange(len(x)), x, 10, 100)
    assert got.keys() == want.keys()
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.9


def test_a_repeated_key_has_the_vector_that_sorts_first(spark):
    rows = [(100, [1.0, 0.0]), (1, [5.0, 0.0]), (1, [2.0, 0.0]), (1, [3.0, 0.0])]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<float>")
        assert [tuple(r) for r in neighbours.neighbours(df, F.col("vec_id") % 100 == 0).collect()] == [(100, 1, 1, 1.0)]


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 1.0]), (6, [2.0, 0.0]), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (8, []), (0, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert [tuple(r) for r in neighbours.neighbours(df, F.col("vec_id") % 100 == 0).collect()] == [(0, 1, 6, 1.0)]
    assert neighbours.neighbours(df.limit(0), F.lit(True)).count() == 0
