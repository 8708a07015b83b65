"""The pipeline keeps what is clean and takes out what was planted."""

import random

from pyspark.sql import functions as F

import corpus_pipeline

WORDS = ["the", "of", "and", "river", "stone", "walks", "under", "light", "green", "over", "small", "house"]


def test_each_stage_takes_out_its_own(spark, tmp_path):
    rng = random.Random(9)
    say = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n)).capitalize() + "."
    good = [say(120) for _ in range(120)]
    junk = [" ".join(w + "$$$" for w in say(100).upper().split()) for _ in range(60)]
    exam, passage = say(40), say(90)
    copies = [good[0], good[1] + " end"]
    leaked = [say(60) + " " + exam]
    shared = [say(80) + " " + passage + " " + say(30), say(70) + " " + passage]
    texts = [*good, *junk, *copies, *leaked, *shared, None, "", "tiny"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, int(not 120 <= i < 180), 0) for i in range(len(texts) - 3)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, exam)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    at, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = spark.createDataFrame(stage(spark, at, str(tmp_path)).collect(), docs.schema)
        assert at.columns == docs.columns
        seen.append({r["doc_id"]: r["text"] for r in at.collect()})
    first = {i for i in range(120)}
    assert first <= seen[0].keys()
    assert not set(range(120, 180)) & seen[0].keys()
    assert seen[0].keys() - seen[1].keys() == {180, 181}
    assert first <= seen[1].keys()
    assert all(passage[20:-20] not in t for i, t in seen[2].items() if t and i in (183, 184))
    assert all(seen[2][i] == good[i] for i in first)
    assert seen[2].keys() - seen[3].keys() == {182}
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == seen[3].keys()
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_rows_that_share_an_id_or_have_none(spark, tmp_path):
    rng = random.Random(12)
    a, b, c, d, e, f = (" ".join(f"w{rng.randrange(4000)}" for _ in range(60)) for _ in range(6))
    rows = [(1, a), (1, b), (2, b + " end"), (3, c), (3, c), (4, d), (4, c), (None, e), (None, e), (None, e + " end"), (None, a), (None, f), (9, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.one_of_each(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = [(r["doc_id"], (r["text"] or "").removesuffix(" end")) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([(1, a), (1, b), (3, c), (4, d), (None, e), (None, f), (9, ""), (8, "")], key=str)


def test_stages_of_odd_rows_and_empty_tables(spark, tmp_path):
    rng = random.Random(5)
    say = lambda n: " ".join(rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(n))
    long, passage = say(40_000), say(90)
    rows = [(1, None), (2, ""), (None, say(50)), (None, None), (3, long), (4, say(30) + " " + passage), (5, passage + " " + say(30)), (6, say(40)), (6, say(40)), (7, "  \n")]
    rows = [*rows, rows[7], rows[2]]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], names)
    clashing = docs.withColumns({c: F.lit(7) for c in ("score", "row", "n_bytes", "removed", "id", "n", "item", "part")})
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 7)] + [(None, 1, 0), (1, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(None, None), (1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[1:]:
        got = stage(spark, clashing, str(tmp_path)).collect()
        ids = {r["doc_id"] for r in got}
        assert ids == {1, 2, 3, 4, 5, 6, 7, None}, name
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, docs.limit(0), str(tmp_path))
        assert empty.count() == 0, name
        assert stage is corpus_pipeline.packed or empty.columns == docs.columns
    kept = corpus_pipeline.good_quality(spark, clashing, str(tmp_path))
    assert kept.columns == docs.columns
    assert kept.count() <= len(rows)
    texts = [r["text"] for r in corpus_pipeline.without_repeats(spark, clashing, str(tmp_path)).collect()]
    assert long in texts
    assert not any(passage[20:-20] in (t or "") for t in texts)


def test_passages_of_over_fifty_words_go_though_short(spark, tmp_path):
    rng = random.Random(8)
    say = lambda n: " ".join(f"{rng.choice('abcdefgh')}{rng.randrange(999)}" for _ in range(n))
    passage, fifty = say(51), say(50)
    assert len(passage) < 400
    texts = [f"{say(60)} {passage} {say(20)}", f"{passage} {say(90)}", f"{say(40)} {fifty} {say(30)}", f"{fifty} {say(30)}", passage]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in corpus_pipeline.without_repeats(spark, docs, str(tmp_path)).collect()}
    assert {i: r["text"] for i, r in got.items()} == {0: texts[0].replace(passage, ""), 1: texts[1].replace(passage, ""), 2: texts[2], 3: texts[3]}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
