"""Manifest proofs against trees made by hand, and against SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tallytree.llm import common, merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, tree int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(level):
    """Root of leaves, and the siblings of each, level by level."""
    proof, at = [""] * len(level), list(range(len(level)))
    while len(level) > 1:
        proof = [p + "".join(level[k] for k in range(a // 8 * 8, min(a // 8 * 8 + 8, len(level))) if k != a) for p, a in zip(proof, at, strict=True)]
        level, at = [h(*level[k : k + 8]) for k in range(0, len(level), 8)], [a // 8 for a in at]
    return level[0], proof


def expected(rows):
    leaf = lambda r, text: h(enc(r[0]), enc(r[3]), enc(r[2]), enc(r[4]), enc(text))
    low = lambda t: t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    mine = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for g in langs}
    trees = {g: tree([leaf(r, r[1]) for r in mine[g]]) for g in langs}
    root, tops = tree([trees[g][0] for g in langs])
    out = []
    for g, top in zip(langs, tops, strict=True):
        for r, proof in zip(mine[g], trees[g][1], strict=True):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            same = not hit or low(r[1]) == r[1]
            out.append((r[0], leaf(r, r[1]), trees[g][0], root, h(proof, top), same))
    return out


def given(spark, tmp_path, rows, partitions=3):
    frame = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    frame.repartition(partitions).write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def made(n, langs, seed=1):
    rng = random.Random(seed)
    ids = rng.sample(range(-50, 10 * n), n)
    return [(i, rng.choice(["Some Text", "low", "", None, "É à Ö Ab" * 40]), rng.choice(langs), rng.choice(["a", None]), rng.choice([3, None])) for i in ids]


@pytest.mark.parametrize(("n", "langs", "few"), [(700, ["en", None, "de", "x"], None), (90, [f"l{k}" for k in range(40)], None), (90, [f"l{k}" for k in range(40)], 3), (9, ["en"], None), (1, ["en"], None), (8, [None], 0)])
def test_proofs_are_those_of_the_trees(spark, tmp_path, monkeypatch, n, langs, few):
    if few is not None:  # heights that are joined without a broadcast, and hot groups
        monkeypatch.setattr(merkle, "BROADCAST_NODES", few)
        monkeypatch.setattr(common, "HOT_KEYS", 3)
    rows = made(n, langs)
    rows += [rows[0]] * (n > 1) + [(None, "T", langs[0], None, None)] * 2 * (n > 8) + [(rows[0][0], "other", rows[0][2], None, 1)] * (n > 8)
    got = queries.op12_manifest(spark, given(spark, tmp_path, rows)).collect()
    want = expected(rows)
    plain = lambda xs: sorted(xs, key=str)
    assert plain((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["verified"]) for r in got) == plain(want)
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in got)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.sql(queries.ORACLE_SQL["op12_manifest"])
    assert plain(map(tuple, sql.fetchall())) == plain(tuple(r[c] for c in sql.columns) for r in got)


def test_manifest_of_an_empty_table_and_of_one_group_of_copies(spark, tmp_path):
    assert queries.op12_manifest(spark, given(spark, tmp_path / "none", [])).count() == 0
    rows = [(5, "A copy", "en", "s", 6)] * 600
    m = merkle.manifest(spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA).repartition(5))
    proof = merkle.proofs(m)
    assert proof.where(merkle.folded(F.col("digest"), F.col("steps")) == m.root).count() == 600
    assert proof.where(merkle.folded(F.sha2(F.lit("other"), 256), F.col("steps")) == m.root).count() == 0
    assert m.leaves.select("number").distinct().count() == 600
    assert m.root == expected(rows)[0][3]
