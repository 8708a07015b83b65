"""Readers, the label tree, confidence and cohort counts on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from tallytree.operators import aggregate, cohort, concordance, confidence, taxonomy
from tallytree.schema import checked_ranks, checked_threshold, tier_suffix
from tallytree.sources import readers

TREE = [(1, 1), (2, 1), (469, 2), (1210098, 469), (2759, 1), (33208, 2759), (9606, 33208)]


@pytest.fixture(scope="module")
def lineage(spark):
    return taxonomy.closure(spark.createDataFrame(TREE, "tax_id long, parent_id long")).cache()


def test_reports_are_parsed_and_the_last_of_a_sample_counts(spark, tmp_path):
    for folder, n in (("a", 5), ("b", 7)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "S1.kraken2.report.txt").write_text(f"# note\n\n50.0\t{n}\t{n}\tS\t562\t  Escherichia coli\n1\t2\t3\nx\t1\t1\tS\t1\tbad\n")
    rows = readers.read_reports(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert rows.count() == 2
    (row,) = aggregate.latest_reports(rows).collect()
    assert (row["sample_id"], row["direct_reads"], row["name"], row["rank"]) == ("S1", 7, "Escherichia coli", "S")


def test_outputs_nodes_names_and_summaries(spark, tmp_path):
    (tmp_path / "S1.kraken2.output.txt").write_text("C\tr1\t562\t150\t562:5\nC\tr2\tx\t1\t0:1\nshort\n")
    assert [(r["sample_id"], r["read_id"], r["tax_id"]) for r in readers.read_outputs(spark, str(tmp_path / "S1.kraken2.output.txt")).collect()] == [("S1", "r1", 562)]
    (tmp_path / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n562\t|\t1\t|\tspecies\t|\n")
    assert sorted(map(tuple, readers.read_nodes(spark, str(tmp_path / "nodes.dmp")).collect())) == [(1, 1, "-"), (562, 1, "S")]
    (tmp_path / "names.dmp").write_text("562\t|\tEscherichia coli\t|\t\t|\tscientific name\t|\n562\t|\tE. coli\t|\t\t|\tsynonym\t|\n")
    assert [tuple(r) for r in readers.read_names(spark, str(tmp_path / "names.dmp")).collect()] == [(562, "Escherichia coli")]
    for name, n in (("a.json", 5), ("b.json", 9)):
        (tmp_path / name).write_text(json.dumps({"sample_id": "S1", "total_reads": n}))
    assert [r["total_reads"] for r in readers.read_summaries(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")]).collect()] == [9]


def test_matrix_cells_that_are_missing(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("tax_id\tname\ts1\ts2\n562\tE\t1.5\tNA\n")
    at = str(tmp_path / "m.tsv")
    assert {r["sample_id"]: r["value"] for r in readers.read_matrix(spark, at, 0.0).collect()} == {"s1": 1.5, "s2": 0.0}
    assert {r["sample_id"]: r["value"] for r in readers.read_matrix(spark, at).collect()} == {"s1": 1.5, "s2": None}


@pytest.mark.parametrize(
    ("assigned", "kmers", "expected"),
    [(1210098, "0:71 1210098:5 0:40 |:| 9606:3 0:113", 5 / 232), (9606, "9606:100 0:10 33208:5", 100 / 115), (469, "469:5 1210098:5 0:10", 0.5), (1210098, "1210098:5 A:100", 1.0), (0, "0:50", 0.0), (9606, "", 0.0), (9606, "A:50", 0.0)],
)
def test_confidence(spark, lineage, assigned, kmers, expected):
    reads = spark.createDataFrame([("S1", "r", assigned, kmers)], "sample_id string, read_id string, tax_id long, kmers string")
    (row,) = confidence.read_confidence(reads, lineage, "sample_id", "read_id").collect()
    assert row["confidence"] == pytest.approx(expected)


def test_tiers_and_roll_up(spark, lineage):
    reads = spark.createDataFrame([("S1", 9606, 100 / 115), ("S1", 1210098, 5 / 232), ("S1", 0, 0.0)], "sample_id string, tax_id long, confidence double")
    tier = confidence.tiers(reads, [0.0, 0.5])
    assert sorted((r["tier"], r["tax_id"], r["direct_reads"]) for r in tier.collect()) == [("conf0p50", 0, 2), ("conf0p50", 9606, 1)]
    counters = confidence.tier_counters(reads, 0.5).first().asDict()
    assert counters == {"sample_id": "S1", "total_reads": 3, "originally_unclassified": 1, "demoted_to_unclassified": 1, "classified_after_filter": 1}
    direct = spark.createDataFrame([("S1", 1210098, 2)], "sample_id string, tax_id long, direct_reads long")
    assert {r["tax_id"]: r["clade_reads"] for r in taxonomy.roll_up(direct, lineage, "sample_id").collect()} == {1210098: 2, 469: 2, 2: 2, 1: 2}


def test_domains(spark):
    tree = [(1, 1), (2, 1), (1279, 2), (2759, 1), (33208, 2759), (9606, 33208), (10090, 33208), (5794, 2759), (10239, 1)]
    lineage = taxonomy.closure(spark.createDataFrame(tree, "tax_id long, parent_id long"))
    labels = spark.createDataFrame([(x,) for x in (0, 1, 1279, 9606, 10090, 5794, 10239, 77)], "tax_id long")
    got = {r["tax_id"]: r["domain"] for r in taxonomy.domains(labels, lineage).collect()}
    assert got == {0: "Unclassified", 1: "Unclassified", 1279: "Bacteria", 9606: "Human", 10090: "Metazoa_other", 5794: "Protists", 10239: "Viruses", 77: "Unclassified"}


def test_a_cycle_ends(spark):
    pairs = taxonomy.closure(spark.createDataFrame([(1, 2), (2, 1)], "tax_id long, parent_id long"), most=8)
    assert {(r["tax_id"], r["ancestor_id"]) for r in pairs.collect()} == {(1, 1), (1, 2), (2, 1), (2, 2)}


def test_measures_and_checks(spark):
    cells = spark.createDataFrame([("a", 1, 30), ("b", 1, 0)], "sample_id string, tax_id long, raw long")
    direct = spark.createDataFrame([("a", 500), ("b", 0)], "sample_id string, direct_total long")
    totals = spark.createDataFrame([("b", 0)], "sample_id string, total_reads long")
    got = {r["sample_id"]: (r["cpm"], r["abs"]) for r in aggregate.measures(cells, direct, totals).collect()}
    assert got == {"a": (60000.0, None), "b": (0.0, None)}
    assert tier_suffix(0.5) == "conf0p50"
    assert checked_ranks(["S", ""]) == ["S"]
    for wrong in (lambda: checked_ranks(["X"]), lambda: checked_threshold(1.5)):
        with pytest.raises(ValueError):
            wrong()


def test_cohort_small(spark):
    fact = spark.createDataFrame([("a", 1, 3, 3.0, None, "Bacteria"), ("a", 9606, 7, 7.0, 2.0, "Human"), ("b", 1, 5, 5.0, 4.0, None)], "sample_id string, tax_id long, raw long, cpm double, abs double, domain string")
    stats = {r["sample_id"]: r for r in cohort.sample_stats(fact).collect()}
    assert (stats["a"]["nonhuman"], stats["a"]["abs_ppm"], stats["b"]["abs_ppm"], stats["a"]["richness"]) == (3, None, 4.0, 2)
    (row,) = cohort.species(fact, 2).collect()
    assert (row["prevalence"], row["raw_total"], row["burden"], row["band"]) == (1.0, 8, 4.0, "core")
    assert {(r["sample_id"], r["domain"], r["share"]) for r in cohort.composition(fact).collect()} == {("a", "Bacteria", 0.3), ("a", "Human", 0.7), ("b", "Unannotated", 1.0)}
    one = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    assert {tuple(r) for r in concordance.agreement(one, one.limit(1)).collect()} == {("a", "both"), ("b", "first only")}


def test_tokens_of_any_form(spark):
    line = "1:2:3 x |:| A:5 :4 7: 8:y 9:+3\t5:1\n6:0  6:-1 12"
    rows = confidence.tokens(spark.createDataFrame([(line,)], "kmers string")).collect()
    assert [(r["label"], r["n"]) for r in rows] == [("1:2", 3), ("A", 5), ("", 4), ("9", 3), ("5", 1)]


def test_lines_of_one_read_stay_lines(spark, lineage):
    reads = spark.createDataFrame([("r", 469, "469:5 0:5"), ("r", 469, "1210098:5 junk x:y 0:5"), ("s", 0, "0:9"), ("t", 9606, None)], "read_id string, tax_id long, kmers string")
    found = confidence.read_confidence(reads, lineage, "read_id").collect()
    assert sorted((r["read_id"], r["confidence"]) for r in found) == [("r", 0.5), ("r", 0.5), ("s", 0.0), ("t", 0.0)]


def test_strings_of_kmers_are_not_shuffled(spark, lineage):
    reads = spark.range(20).selectExpr("'S' AS sample_id", "id AS read_id", "469L AS tax_id", "concat('469:', id, ' 1210098:2 0:3') AS kmers")
    plan = confidence.read_confidence(reads, lineage.localCheckpoint(), "sample_id", "read_id")._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "kmers" in line and ("Sort" in line or "collect_list" in line)]
    assert not sorts and plan.count("Exchange hashpartitioning(sample_id") == 1


def test_sums_of_batches_are_those_of_the_tokens(spark):
    odd = ["5:3 007:4 +5:2 -5:9 5:+3 5:-3 5.0:2 5:2.5 A:4 |:| :7 5: ::5 5:5:5 junk x:y", "5:3\t5:4\n0:1\x0b5:1\x0c5:2\r5:1", "5:99999999999999999999 5:1234567890123456789 5:\x013 \x015:2 5:3\x01 5\x7f:4 5:4\x7f 00000000000000000000005:2", "9223372036854775808:1 5:00000000000000000000002", "", None, " ", "é:5 ५:4 5:3é"]
    reads = spark.createDataFrame([(i, label, x) for i, x in enumerate(odd) for label in (5, 7, 0, -1)], "id int, tax_id long, kmers string")
    sums = confidence.own_sums(reads, "id")
    own = confidence.number(F.col("label")) == F.col("tax_id")
    each = confidence.tokens(reads.where("tax_id > 0")).where("label <> 'A'").groupBy("id", "tax_id").agg(F.sum(F.when(own, F.col("n")).otherwise(0)).alias("inside"), F.sum("n").alias("total"))
    told = {(r["id"], r["tax_id"]): (r["inside"], r["total"]) for r in each.collect()}
    assert len(told) == 10
    got = sums.collect()
    assert len(got) == len(odd) * 4 and all((r["lines"], r["inside"], r["total"]) == (1, *told.get((r["id"], r["tax_id"]), (0, 0))) for r in got)
    # in batches, not token by token by functions that Spark interprets
    assert "lambda" not in sums._jdf.queryExecution().executedPlan().toString()
