"""Near duplicates, repeated strings and contamination against brute force."""

import glob
import hashlib
import random
import re
import time
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallytree.llm import common, decontaminate, near_duplicates, passages, queries, repeats

SCHEMA = "doc_id long, text string, id int, key string, n long, comp long"


def table(spark, texts, first=0):
    return spark.createDataFrame([(first + i, t, 0, "k", 0, 0) for i, t in enumerate(texts)], SCHEMA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def near_texts(seed=4):
    rng = random.Random(seed)
    texts = [" ".join(words(rng, rng.randint(1, 60))) for _ in range(40)]
    base = words(rng, 80)
    for share in (0, 0.002, 0.005, 0.01, 0.02, 0.04) * 15:  # a family around the threshold
        texts.append(" ".join(w if rng.random() >= share else f"x{rng.randrange(99)}" for w in base))
    return [*texts, None, "", " \t\n", "one two", "One  TWO", "one two three", texts[0], texts[0]]


def brute_components(texts, percent):
    sets = []
    for t in texts:
        w = re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode().lower())
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    up = list(range(len(texts)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                up[y] = x
    return [(len(s), root(i), root(i) == i) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("percent", "crowd"), [(85, 40), (80, 3)])
def test_near_duplicates_are_those_of_brute_force(spark, monkeypatch, percent, crowd):
    monkeypatch.setattr(near_duplicates, "CROWD", crowd)
    monkeypatch.setattr(near_duplicates, "SHARE", 2)
    texts = near_texts()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(table(spark, texts), percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute_components(texts, percent)


def test_near_duplicates_of_odd_tables(spark):
    assert near_duplicates.near_duplicates(table(spark, []), 85).count() == 0
    rows = table(spark, ["a b c d e f"] * 2).withColumn("doc_id", F.lit(None).cast("long"))
    assert {tuple(r) for r in near_duplicates.near_duplicates(rows, 85).collect()} == {(None, 2, None, True)}
    twice = table(spark, ["a b c d e f"]).unionByName(table(spark, ["a b c d e f"]))
    assert [tuple(r) for r in near_duplicates.near_duplicates(twice, 85).collect()] == [(0, 2, 0, True)] * 2


def test_long_chains_end_at_the_smallest(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (41, 50), (7, 7)], "a long, b long")
    got = {r["node"]: r["comp"] for r in near_duplicates.components(edges).collect()}
    assert got == {i: 0 for i in range(31)} | {40: 40, 41: 40, 50: 40}


def test_the_index_keeps_its_guarantee():
    assert near_duplicates.index(0.85, 5, 1, 1).distance == 2 * near_duplicates.index(0.85, 5, 1, 1).chunks - 1
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64)) for _ in range(60)]
    keys = near_duplicates.keys_of(np.repeat(np.arange(60), [len(s) for s in sets]), np.concatenate(sets), 60, near_duplicates.index(0.85, 5, 1, 17))
    assert len(np.unique(keys)) == keys.size  # long texts that have nothing in common share no key


@pytest.mark.parametrize("draws", [1, 8])
def test_crowds_lose_no_pair(spark, monkeypatch, draws):
    """Families of hundreds around the threshold, some with a passage that all have and that dominates."""
    monkeypatch.setattr(near_duplicates, "CROWD", 3)
    monkeypatch.setattr(near_duplicates, "DRAWS", draws)
    rng = random.Random(8)
    base, passage = words(rng, 120), words(rng, 60)
    texts = [" ".join(w if rng.random() >= share else f"x{rng.randrange(9999)}" for w in base) for share in (0.002, 0.01, 0.02, 0.03, 0.05) * 50]
    texts += [" ".join(passage + words(rng, rng.randint(0, 40), 9999)) for _ in range(60)]
    texts += [" ".join(base[: rng.randint(60, 120)] + words(rng, 300, 9999)) for _ in range(10)]
    for percent in (80 if draws == 1 else 85,):
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(table(spark, texts), percent).collect()}
        assert [got[i] for i in range(len(texts))] == brute_components(texts, percent)


def test_rows_of_one_key_are_one_document(spark):
    rows = table(spark, ["a b c d e f"]).unionByName(table(spark, ["u v w x y z"])).unionByName(table(spark, ["u v w x y z"], 7))
    assert sorted(tuple(r) for r in near_duplicates.near_duplicates(rows, 85).collect()) == [(0, 2, 0, True), (0, 2, 0, True), (7, 2, 0, False)]


def brute_repeats(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for raw in raws:
        runs = []
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                if runs and i <= runs[-1][1]:
                    runs[-1][1] = i + length
                else:
                    runs.append([i, i + length])
        gone = {k for a, b in runs for k in range(a, b)}
        rest = bytes(x for k, x in enumerate(raw) if k not in gone)
        out.append((len(raw), len(gone), len(runs), hashlib.sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_are_those_of_brute_force(spark, seed):
    rng = random.Random(seed)
    some = lambda n, letters="abcdefgh é": "".join(rng.choice(letters) for _ in range(n))
    passage, other = some(900), some(450)
    texts = [some(rng.randint(0, 1500)) for _ in range(12)]
    texts += [some(50) + passage + some(70), passage[3:] + some(30), some(9) + passage[100:700], passage[:399], passage[:401], other, other + other, "é" * 700, "=" * 1500, "=" * 1500, "ab" * 600, None, "", texts[0], texts[0]]
    texts += ["=" * 900, "ab" * 600 + "x", "xy" * 900, some(30) + "line of text\n" * 60, "line of text\n" * 50 + some(20), passage[200:] + other, passage[:500] + some(600)]
    texts += [some(rng.randint(0, 40)) + passage[k : k + 400 + rng.randint(0, 99)] for k in range(0, 400, 37)]
    found = repeats.remove_repeats(table(spark, texts))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    got = {r[0]: tuple(r[1:]) for r in found.select("doc_id", "n_bytes", removed, F.size("removed"), F.sha2("kept", 256)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts, 400)


def test_a_line_over_and_over_is_joined_once_a_text(spark, monkeypatch):
    texts = [f"{k} " * 9 + "a very common line of the corpus\n" * (200 + k) for k in range(8)]
    real, joined = repeats.matched, []

    def counted(rows, keys, on, how="left_semi"):
        out = real(rows, keys, on, how)
        joined.append(out.count())
        return out

    monkeypatch.setattr(repeats, "matched", counted)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    found = repeats.remove_repeats(table(spark, texts)).select("doc_id", "n_bytes", removed, F.size("removed"), F.sha2("kept", 256))
    assert [tuple(r[1:]) for r in sorted(found.collect())] == brute_repeats(texts, 400)
    distinct = len({t[i : i + 400] for t in texts for i in range(len(t) - 399)})
    assert joined[0] < distinct // 2  # not a row for each of the line's 1,600 places


def test_what_was_shuffled_for_a_scratch_table_goes(spark):
    at = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    held = lambda: {f for d in at for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}
    before = held()
    rows = common.written(spark.range(20_000).groupBy((F.col("id") % 500).alias("k")).count())
    ends = time.time() + 10
    while (left := held() - before) and time.time() < ends:  # files go in the background
        time.sleep(0.1)
    assert not left and rows.count() == 500


def test_repeats_of_odd_tables(spark):
    assert repeats.remove_repeats(table(spark, [])).count() == 0
    twice = table(spark, ["q" * 100 + "xyz" * 200]).unionByName(table(spark, ["q" * 100 + "xyz" * 200]))
    assert [(r["text"], len(r["removed"])) for r in repeats.remove_repeats(twice).collect()] == [("", 1)] * 2
    nameless = twice.withColumn("doc_id", F.lit(None).cast("long"))
    assert [r["text"] for r in repeats.remove_repeats(nameless).collect()] == ["", ""]


def test_repeats_of_unlike_texts_that_share_a_key(spark, monkeypatch):
    rng = random.Random(11)
    some = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage = some(600)
    texts = [some(1500) + passage + some(900), some(60) + passage[10:520], some(700), passage[3:] + some(20), some(200), "tie" * 300, passage + some(5), passage[:450] + some(90)]
    keys = [1, 1, 1, 2, 2, None, None, 1]
    rows = spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id long, text string")
    for windows, hot in ((repeats.WINDOWS, common.HOT_KEYS), (50, 3)):
        monkeypatch.setattr(repeats, "WINDOWS", windows)
        monkeypatch.setattr(common, "HOT_KEYS", hot)
        removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
        got = repeats.remove_repeats(rows).select("doc_id", "n_bytes", removed, F.size("removed"), F.sha2("kept", 256)).collect()
        want = [(k, *r) for k, r in zip(keys, brute_repeats(texts, 400), strict=True)]
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def brute_passages(texts, n):
    found = [list(re.finditer(rb"[^\x20\x09-\x0D]+", (t or "").encode())) for t in texts]
    of = [[tuple(w[0] for w in ws[i : i + n]) for i in range(len(ws) - n + 1)] for ws in found]
    texts_of = Counter(window for windows in of for window in set(windows))
    spans = [[(ws[i].start(), ws[i + n - 1].end()) for i, window in enumerate(windows) if texts_of[window] > 1] for ws, windows in zip(found, of, strict=True)]
    return [repeats.merged([{"lo": a, "end": b} for a, b in s]) for s in spans]


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_are_those_of_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    say = lambda n: " ".join(words(rng, n))
    line, passage, long = say(20), say(51), say(160).split()
    texts = [say(rng.randint(0, 200)) for _ in range(12)]
    texts += [f"{say(30)} {passage} {say(9)}", passage, f"{say(70)}\n{passage}", passage.replace(" ", "\n\t"), " ".join(passage.split()[:50]) + " x", passage.upper(), f"é{passage}"]
    texts += [" ".join([*words(rng, 9), *long[a:b], *words(rng, rng.randint(0, 60))]) for a, b in [(0, 160), (3, 90), (60, 111), (60, 110), (80, 160), (20, 140), (0, 70)]]
    texts += [" ".join(f"y{rng.randrange(9)}" if rng.random() < 0.02 else w for w in long) for _ in range(12)]
    own = say(60)  # twice, but in one text
    texts += [f"{own} {own}", "x " * 300, "x " * 200 + "y", "z " * 200, f"{line} " * 40, f"{say(5)} {line} {line} {line}", f"{say(8)} {line} {say(80)}", texts[3], None, ""]
    brute = brute_passages(texts, 51)
    assert any(brute) and not all(brute)
    for held, hot in ((passages.WINDOWS, common.HOT_KEYS), (70, 3)):
        monkeypatch.setattr(passages, "WINDOWS", held)
        monkeypatch.setattr(common, "HOT_KEYS", hot)
        found = repeats.remove_repeats(table(spark, texts), 100_000, also=passages.repeated_passages).select("doc_id", "removed").collect()
        assert [[tuple(r) for r in d["removed"]] for d in sorted(found)] == brute


def test_op6_tells_passages_and_removes_by_bytes(spark, tmp_path):
    rng = random.Random(3)
    say = lambda n: " ".join(words(rng, n))
    short, long = say(51), say(120)
    assert len(short) < 400 < len(long)
    texts = [f"{say(40)} {short}", f"{short} {say(9)}", f"{say(40)} {long}", f"{long} {say(9)}", say(90), None, f"{say(3)} {short}", short + " " + "q" * 380, "q" * 390 + "!", "r" * 500, "r" * 500]
    rows = table(spark, texts).withColumn("doc_id", F.when(F.col("doc_id") != 6, F.col("doc_id") % 10))  # 6 has none, 10 is another 0
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op6_repeats(spark, str(tmp_path)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "passage").collect()
    brute = [(k if k != 6 else None, *r, bool(p)) for k, r, p in zip([*range(10), 0], brute_repeats(texts, 400), brute_passages(texts, 51), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute))
    assert any(r["passage"] and not r["n_removed"] for r in got) and any(r["n_removed"] and not r["passage"] for r in got)


def test_contamination_is_that_of_sql(spark, tmp_path):
    rng = random.Random(6)
    item = words(rng, 30)
    texts = [" ".join(words(rng, rng.randint(0, 80))) for _ in range(20)]
    texts += [" ".join([*words(rng, 40), *item[5:25], *words(rng, 9)]), " ".join(item).upper(), "; ".join(item[:13]), " ".join(item[:12]), "Short Item here", "short item", None, "", "é…!", "w1"]
    docs = table(spark, [*texts, texts[20]])
    bench = spark.createDataFrame([(10, " ".join(item), "x"), (2, "short item", "x"), (3, None, "x"), (4, " ".join(item[:14]), "x"), (5, " ".join(item), "x")], "item_id long, text string, row string")
    for name, df in (("documents", docs), ("benchmark", bench)):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(queries.ORACLE_SQL["op7_decontamination"])
    got = queries.op7_decontamination(spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert got.where("contaminated").count() >= 5


def test_contamination_of_odd_tables(spark):
    docs = table(spark, ["a b", None])
    bench = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert sorted(tuple(r)[:4] for r in decontaminate.contamination(docs, bench).collect()) == [(0, 2, 2, ["1"]), (1, 0, 0, [])]
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert {r["n_hit"] for r in decontaminate.contamination(docs, bench.limit(0)).collect()} == {0}
    twice = docs.unionByName(docs).withColumn("doc_id", F.lit(None).cast("long"))
    assert sorted(r["n_hit"] for r in decontaminate.contamination(twice, bench).collect()) == [0, 0, 2, 2]


def test_a_shuffled_join_deals_texts_evenly(spark, monkeypatch):
    """Where the benchmark's hashes are too many to broadcast, no task gets a row of every text."""
    monkeypatch.setattr(decontaminate, "sized", lambda df, most=0: df.hint("merge"))
    rng = random.Random(8)
    docs = table(spark, [" ".join(words(rng, 20)) for _ in range(400)])
    item = " ".join(words(rng, 30))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs.unionByName(table(spark, [item + " end"], 1000))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"]) for r in decontaminate.contamination(docs, bench).collect()}
    assert len(got) == 401
    assert got.pop(1000) == (31, 30)
    assert set(got.values()) == {(20, 0)}
    asked = decontaminate.asked_of(docs.withColumn("row", F.xxhash64("text")).drop("doc_id").withColumn("doc_id", F.lit(1)), "doc_id", [])
    tasks = asked.where("span = -1").repartition(8, "span", "f").withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(tasks) == 8
    assert max(r["count"] for r in tasks) < 100


def test_items_without_ids_are_searched(spark, tmp_path):
    rng = random.Random(7)
    known, leaked = words(rng, 20), words(rng, 30)
    texts = [" ".join([*words(rng, 30), *leaked[4:24]]), " ".join([*known, "and", *leaked]), " ".join(known), "tiny text", " ".join(words(rng, 40)), None]
    docs = table(spark, texts)
    bench = spark.createDataFrame([(None, " ".join(leaked)), (None, " ".join(leaked[:20])), (None, "tiny text"), (None, None), (7, " ".join(known)), (8, " ".join(leaked[:14]))], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.contamination(docs, bench).collect()}
    assert {k: (r["n_hit"], r["items"]) for k, r in got.items()} == {0: (20, [None]), 1: (50, ["7", "8", None]), 2: (20, ["7"]), 3: (2, [None]), 4: (0, []), 5: (0, [])}
    for name, df in (("documents", docs), ("benchmark", bench)):
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    want = con.sql(queries.ORACLE_SQL["op7_decontamination"])
    found = queries.op7_decontamination(spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, found.collect())) == sorted(want.fetchall())
    kept = corpus_pipeline.uncontaminated(spark, docs.withColumns({c: F.lit(None) for c in ("lang", "source", "n_chars")}), str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == {4, 5}
