"""From report files to flags and a report, through the shell's entry."""

import gzip
import json

from pyspark.sql import functions as F

from tallytree import cli
from tallytree.sources import sinks
from tallytree.streaming import arrivals


def reports(folder, n=6):
    folder.mkdir()
    for i in range(n):
        spike = 5000 if i == n - 1 else 50 + i % 3
        (folder / f"S{i}.kraken2.report.txt").write_text(f"80\t{800 + i}\t{800 + i}\tU\t0\tunclassified\n20\t{spike}\t{spike}\tS\t562\tEscherichia coli\n")
        (folder / f"S{i}.json").write_text(json.dumps({"sample_id": f"S{i}", "total_reads": 1000000}))


def test_aggregate_detect_report(spark, tmp_path):
    reports(tmp_path / "in")
    assert cli.main(["aggregate", f"{tmp_path}/in/*.report.txt", "--idxstats", f"{tmp_path}/in/*.json", "--out", f"{tmp_path}/cohort", "--wide"]) == 0
    raw = spark.read.csv(f"{tmp_path}/cohort/taxa_matrix_raw.tsv", sep="\t", header=True)
    assert raw.columns == ["tax_id", "name", *(f"S{i}" for i in range(6))]
    assert [r["S5"] for r in raw.orderBy("tax_id").collect()] == ["805", "5000"]
    assert [r["S0"] for r in spark.read.csv(f"{tmp_path}/cohort/taxa_matrix_abs.tsv", sep="\t", header=True).orderBy("tax_id").collect()] == ["800.0000", "50.0000"]
    assert cli.main(["detect", f"{tmp_path}/cohort", "--method", "mad", "--out", f"{tmp_path}/flags"]) == 0
    assert [r[0] for r in spark.read.text(f"{tmp_path}/flags/quarantine_list.txt").collect()] == ["S5"]
    assert cli.main(["report", f"{tmp_path}/cohort", f"{tmp_path}/flags", "--out", f"{tmp_path}/report"]) == 0
    html = spark.read.text(f"{tmp_path}/report/report_html", wholetext=True).first()[0]
    assert "Species summary" in html
    assert "S5" in html


def test_samples_stay_and_names_may_have_dots(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, reads in (("S.1", 50), ("S.2", 3), ("S0", 70)):
        (folder / f"{name}.kraken2.report.txt").write_text(f"80\t4\t4\tU\t0\tunclassified\n20\t{reads}\t{reads}\tS\t562\tEscherichia coli\n")
    for name in ("S.1", "S.2"):
        (folder / f"{name}.json").write_text(json.dumps({"sample_id": name, "total_reads": 1000000}))
    assert cli.main(["aggregate", f"{folder}/*.report.txt", "--idxstats", f"{folder}/*.json", "--out", f"{tmp_path}/cohort", "--wide", "--min-reads", "10"]) == 0
    read = lambda kind: spark.read.csv(f"{tmp_path}/cohort/taxa_matrix_{kind}.tsv", sep="\t", header=True)
    assert read("raw").columns == ["tax_id", "name", "S.1", "S.2", "S0"]
    assert tuple(read("raw").first()) == ("562", "Escherichia coli", "50", "0", "70")
    assert tuple(read("abs").first())[2:] == ("50.0000", "0.0000", "NA")
    assert tuple(read("raw_S").first())[2:] == ("50", "0", "70")
    meta = json.loads(spark.read.text(f"{tmp_path}/cohort/aggregation_metadata.json").first()[0])
    assert (meta["sample_count"], meta["taxon_count"], meta["samples_without_totals"]) == (3, 1, "S0")
    assert cli.main(["aggregate", f"{folder}/*.json", "--out", f"{tmp_path}/none"]) == 1


def test_tiers_go_through_all_steps(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "nodes.dmp").write_text("".join(f"{a}\t|\t{b}\t|\t{r}\t|\n" for a, b, r in ((1, 1, "no rank"), (2, 1, "superkingdom"), (561, 2, "genus"), (562, 561, "species"))))
    for i in range(6):
        good = 400 if i == 5 else 20 + i % 3
        (folder / f"S{i}.kraken2.report.txt").write_text(f"80\t9\t9\tU\t0\tunclassified\n20\t{good}\t0\tG\t561\tEscherichia\n20\t{good}\t{good}\tS\t562\tEscherichia coli\n")
        (folder / f"S{i}.json").write_text(json.dumps({"sample_id": f"S{i}", "total_reads": 1000000}))
        if i:  # one sample has no output
            lines = [f"C\tr{k}\t562\t150\t562:{90 if k % 2 else 10} 0:{10 if k % 2 else 90}" for k in range(good)] + ["U\tu\t0\t150\t0:9"]
            (folder / f"S{i}.kraken2.output.txt").write_text("\n".join(lines))
    base = ["aggregate", f"{folder}/*.report.txt", "--idxstats", f"{folder}/*.json", "--nodes", f"{folder}/nodes.dmp", "--outputs", f"{folder}/*.output.txt", "--confidence-threshold", "0.5", "--out", f"{tmp_path}/cohort"]
    assert cli.main(base) == 0
    cells = spark.read.parquet(f"{tmp_path}/cohort/cells").where("tier = 'conf0p50'")
    got = {(r["rank_scope"], r["sample_id"], r["tax_id"]): (r["raw"], round(r["cpm"]), round(r["abs"])) for r in cells.collect()}
    assert got["all", "S5", 562] == (200, round(200 / 401 * 1e6), 200)
    assert got["G", "S5", 561] == got["S", "S5", 562] == got["all", "S5", 562]
    assert not [k for k in got if k[1] == "S0"]
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/cohort/demoted").collect()} >= {("S5", "conf0p50", 200)}
    assert cli.main(["detect", f"{tmp_path}/cohort", "--method", "mad", "--out", f"{tmp_path}/flags"]) == 0
    for part in ("", "G/", "S/", "conf0p50/", "abs/", "abs/conf0p50/"):
        assert "S5" in {r[0] for r in spark.read.text(f"{tmp_path}/flags/{part}quarantine_list.txt").collect()}, part
    assert cli.main(["report", f"{tmp_path}/cohort", f"{tmp_path}/flags", "--out", f"{tmp_path}/report"]) == 0
    html = spark.read.text(f"{tmp_path}/report/report_html", wholetext=True).first()[0]
    for title in ("Agreement of tiers", "Prevalence and burden", "Diversity", "Notable samples", "Discussion"):
        assert title in html
    assert spark.read.csv(f"{tmp_path}/report/per_sample_summary.tsv", sep="\t", header=True).count() == 6


def test_arriving_reports_are_taken_in_once(spark, tmp_path):
    reports(tmp_path / "in", 2)
    for name in (tmp_path / "in").glob("*.json"):
        name.unlink()
    for _ in range(2):
        arrivals.keep_counts(spark, f"{tmp_path}/in", f"{tmp_path}/table", f"{tmp_path}/seen").awaitTermination(120)
    assert spark.read.parquet(f"{tmp_path}/table").count() == 4


def test_what_cant_be_read_is_told(spark, tmp_path):
    reports(tmp_path / "in", 2)
    (tmp_path / "in" / "S7.kraken2.report.txt").write_text("# only a comment\n1\t2\t3\n")
    (tmp_path / "in" / "S8.kraken2.report.txt").write_text("")
    with open(tmp_path / "in" / "S0.kraken2.report.txt", "a") as f:
        f.write("1\tx\t3\tS\t9\tname\n1\t2\n\n#\n1\ty\t3\tS\t9\tname\n")
    db = tmp_path / "db" / "taxonomy"
    db.mkdir(parents=True)
    (db / "nodes.dmp").write_text("".join(f"{a}\t|\t{b}\t|\t{r}\t|\n" for a, b, r in ((1, 1, "no rank"), (2, 1, "superkingdom"), (561, 2, "genus"), (562, 561, "species"))))
    (db / "names.dmp").write_text("561\t|\tEscherichia\t|\t\t|\tscientific name\t|\n561\t|\tother\t|\t\t|\tsynonym\t|\n562\t|\tnot this\t|\t\t|\tscientific name\t|\n")
    (tmp_path / "in" / "S1.kraken2.output.txt").write_text("C\tr\t562\t150\t562:9\nC\tq\t562\t150\t562:1 0:9\n")
    (tmp_path / "in" / "S0.kraken2.output.txt").write_text("")
    out = f"{tmp_path}/cohort"
    assert cli.main(["aggregate", f"{tmp_path}/in/*.report.txt", "--idxstats", f"{tmp_path}/in/*.json", "--db-path", f"{tmp_path}/db", "--outputs", f"{tmp_path}/in/*.output.txt", "--confidence-threshold", "0.5", "--out", out]) == 0
    meta = json.loads(spark.read.text(f"{out}/aggregation_metadata.json").first()[0])
    assert [x["file"].rpartition("/")[2] for x in meta["errors"]] == ["S7.kraken2.report.txt", "S8.kraken2.report.txt"]
    assert (meta["lines_read"], meta["lines_quarantined"], meta["samples"], meta["domain_annotated"]) == (4, 4, ["S0", "S1"], True)
    assert json.loads(meta["sample_provenance"]["S0"])["total_reads"] == 1000000
    assert meta["matrix_paths"]["abs"] == "taxa_matrix_abs.tsv"
    facts = json.loads(meta["confidence_tiers"]["conf0p50"])
    assert (facts["samples_with_output"], facts["samples_without_output"], facts["reads_demoted_to_unclassified"], facts["taxon_count"]) == (["S1"], ["S0"], {"S1": 1}, 2)
    found = {(r["source_path"].rpartition("/")[2], r["problem"]): r["lines"] for r in spark.read.parquet(f"{out}/problems").collect()}
    assert found == {("S0.kraken2.report.txt", "a number that can't be read"): 2, ("S0.kraken2.report.txt", "too few fields"): 1, ("S7.kraken2.report.txt", "too few fields"): 1}
    names = {r["tax_id"]: r["name"] for r in spark.read.parquet(f"{out}/labels").collect()}
    assert (names[561], names[562]) == ("Escherichia", "Escherichia coli")
    empty = spark.read.parquet(f"{out}/tier_reports").where("sample_id = 'S0'").collect()
    assert [(r["tax_id"], r["clade_reads"]) for r in empty] == [(0, 0)]
    ranks = {r["rank"]: r["taxon_count"] for r in spark.read.json(f"{out}/rank_filter_metadata.json").collect()}
    assert ranks == {"S": 1, "G": 0, "F": 0}
    assert cli.main(["detect", out, "--method", "mad", "--out", f"{tmp_path}/flags"]) == 0
    assert cli.main(["summary", out, f"{tmp_path}/flags", "--out", f"{tmp_path}/summary"]) == 0
    told = json.loads("\n".join(r[0] for r in spark.read.text(f"{tmp_path}/summary/pipeline_mqc.yaml").collect()))
    counted = told["custom_data"]["tallytree"]["data"]["Pipeline Run"]
    assert (counted["Samples"], counted["Taxa in Matrix"], counted["Detection Method"], counted["Quarantined Samples"]) == (2, 2, "mad", 0)


def test_a_wide_file_of_many_samples(spark, tmp_path):
    """20,000 columns, a task holding one line at a time."""
    n = 20_000
    samples = [f"S.{i:05d}" for i in range(n)]
    cells = spark.range(n).select(F.format_string("S.%05d", "id").alias("sample_id"), F.explode(F.array(F.lit(7).cast("long"), F.lit(9).cast("long"), F.col("id") % 5)).alias("tax_id"), (F.col("id") + 1).alias("raw"))
    labels = spark.createDataFrame([(7, 'a "quoted"\tname'), (9, None), (55, "no cells")], "tax_id long, name string")
    sinks.write_matrix(cells, labels, "raw", samples, str(tmp_path / "wide.tsv"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "wide.tsv")).collect()]
    assert all(x.count("\t") >= n + 1 for x in lines)
    rows = {x.split("\t", 1)[0]: x for x in lines if not x.startswith("tax_id")}
    assert sorted(rows) == ["0", "1", "2", "3", "4", "7", "9"]
    assert rows["9"].split("\t")[2:] == [str(i + 1) for i in range(n)]
    assert rows["0"].split("\t")[2:8] == ["1", "0", "0", "0", "0", "6"]
    read = spark.read.csv(str(tmp_path / "wide.tsv"), sep="\t", header=True, maxColumns=n + 10).where("tax_id = 7").first()
    assert (read["name"], read["S.19999"]) == ('a "quoted"\tname', "20000")


def test_batches_that_arrive_equal_one_run(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write = lambda name, at, n: ((folder / at).mkdir(exist_ok=True), (folder / at / f"{name}.kraken2.report.txt").write_text(f"80\t{n}\t{n}\tU\t0\tunclassified\n20\t5\t5\tS\t{560 + n}\tx\n20\t6\t6\tS\t{560 + n}\tx\n"))
    write("S1", "b", 3), write("S2", "b", 4)
    state = lambda at: ({tuple(r) for r in arrivals.snapshot(spark, f"{at}/sums", arrivals.SUMS).drop("batch").collect()}, {tuple(r) for r in arrivals.snapshot(spark, f"{at}/samples", arrivals.SAMPLES).select("sample_id", "source_path", "direct_total", "cells").collect()}, {tuple(r) for r in arrivals.current_cells(spark, at).collect()})
    arrivals.keep_cohort(spark, f"{folder}/*", f"{tmp_path}/two", f"{tmp_path}/seen2").awaitTermination(240)
    write("S1", "c", 7), write("S2", "a", 8), write("S3", "a", 3)
    arrivals.keep_cohort(spark, f"{folder}/*", f"{tmp_path}/two", f"{tmp_path}/seen2").awaitTermination(240)
    arrivals.keep_cohort(spark, f"{folder}/*", f"{tmp_path}/one", f"{tmp_path}/seen1").awaitTermination(240)
    two = state(f"{tmp_path}/two")
    assert two == state(f"{tmp_path}/one")
    assert two[0] == {(0, 14, 3), (567, 6, 1), (564, 6, 1), (563, 6, 1)}
    assert {(r[0], r[1].rpartition("/")[0][-1]) for r in two[1]} == {("S1", "c"), ("S2", "b"), ("S3", "a")}
    again = spark.read.schema(arrivals.ROWS).parquet(f"{tmp_path}/two/rows").where("batch = 1").selectExpr("sample_id", "source_path", "tax_id", "raw AS direct_reads", "0 AS line_ord")
    arrivals.take_in(spark.createDataFrame(again.collect(), again.schema), 1, f"{tmp_path}/two")
    assert state(f"{tmp_path}/two") == two


def test_what_was_extracted(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, reads in (("A_R1.fastq.gz", 3), ("A_R2.fastq.gz", 2), ("B.unmapped.fastq.gz", 0)):
        (folder / name).write_bytes(gzip.compress(b"@r\nACGT\n+\nIIII\n" * reads + b"@cut\n"))
    for name in "ABC":
        (folder / f"{name}.json").write_text(json.dumps({"sample_id": name, "input": f"{name}.bam", "total_reads": 10, "total_mapped": 7, "total_unmapped": 3, "per_chromosome": [{"chrom": "chr1", "length": 5, "mapped": 7, "unmapped": 3}]}))
    assert cli.main(["extraction", f"{folder}/*.gz", "--idxstats", f"{folder}/*.json", "--out", f"{tmp_path}/out"]) == 0
    rows = {r["sample_id"]: r for r in spark.read.csv(f"{tmp_path}/out/extraction_summary.tsv", sep="\t", header=True).collect()}
    assert {k: (r["input"], r["status"], r["read_count"], r["total_mapped"]) for k, r in rows.items()} == {"A": ("A.bam", "OK", "5", "7"), "B": ("B.bam", "OK", "0", "7"), "C": ("C.bam", "FAILED", "0", "7")}
    assert rows["A"]["output_files"].count(";") == 1
    assert spark.read.csv(f"{tmp_path}/out/idxstats.tsv", sep="\t", header=True).count() == 3
