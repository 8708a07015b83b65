"""``python -m tallytree.cli aggregate|detect|report|summary|extraction``: the engine from a shell."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from . import report
from .operators import aggregate, cohort, confidence, detect, ordination, reporting, taxonomy
from .schema import DEFAULT_RANKS, MATRIX_TYPES, METHODS, tier_suffix
from .sources import readers, sinks

#: The tier of all reads.
SENSITIVE = "sensitive"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tallytree", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)
    a = sub.add_parser("aggregate", help="reports to cohort tables")
    a.add_argument("reports", nargs="+")
    a.add_argument("--out", required=True)
    a.add_argument("--min-reads", type=int, default=0)
    a.add_argument("--rank-filter", nargs="*", default=list(DEFAULT_RANKS))
    a.add_argument("--nodes", help="nodes.dmp, for domains and tiers")
    a.add_argument("--names", help="names.dmp, for labels that no report names")
    a.add_argument("--db-path", help="folder with nodes.dmp and names.dmp, or with taxonomy/ that has them")
    a.add_argument("--idxstats", nargs="*", default=[], help="read-total sidecars")
    a.add_argument("--outputs", nargs="*", default=[], help="per-read outputs, for tiers")
    a.add_argument("--confidence-threshold", nargs="*", type=float, default=[0.1])
    a.add_argument("--no-confidence-tiers", action="store_true")
    a.add_argument("--wide", action="store_true", help="wide text matrices too")
    d = sub.add_parser("detect", help="cohort tables to flags")
    d.add_argument("cohort")
    d.add_argument("--out", required=True)
    d.add_argument("--matrix-type", choices=MATRIX_TYPES, default="raw")
    d.add_argument("--method", choices=[*METHODS, "all"], default="all")
    d.add_argument("--mad-threshold", type=float, default=detect.MAD_THRESHOLD)
    d.add_argument("--iqr-multiplier", type=float, default=detect.IQR_MULTIPLIER)
    d.add_argument("--gmm-threshold", type=float, default=detect.GMM_THRESHOLD)
    d.add_argument("--kitome-taxa", nargs="*", type=int, default=[])
    d.add_argument("--no-subtract-background", action="store_true")
    d.add_argument("--rank-filter", nargs="*", default=list(DEFAULT_RANKS), help="ranks that are searched, too")
    d.add_argument("--no-confidence-tiers", action="store_true")
    d.add_argument("--no-abs-detection", action="store_true")
    u = sub.add_parser("summary", help="counts of a whole run")
    u.add_argument("cohort")
    u.add_argument("flags")
    u.add_argument("--out", required=True)
    x = sub.add_parser("extraction", help="what was extracted of each sample")
    x.add_argument("fastq", nargs="+")
    x.add_argument("--idxstats", nargs="+", required=True, help="read-total sidecars of all samples")
    x.add_argument("--out", required=True)
    r = sub.add_parser("report", help="cohort tables and flags to a report")
    r.add_argument("cohort")
    r.add_argument("flags")
    r.add_argument("--out", required=True)
    r.add_argument("--threshold-ppm", type=float, default=1000.0)
    r.add_argument("--cluster-method", choices=[*ordination.LINKAGES, "none"], default="average", help="linkage of the heat maps' trees; none leaves out what stands on distances")
    return top


def parsed_once(spark: SparkSession, paths: list[str], out: str) -> tuple[DataFrame, dict[str, int]]:
    """All lines of the reports, written to ``lines`` once: those that can be read, and a
    quarantine of the others with their problems. And how many of each there were."""
    checked, seen = readers.read_checked(spark, paths), Observation("report lines")
    bad = F.col("problem").isNotNull()
    state = checked.withColumn("state", F.when(bad, "quarantine").otherwise("read"))
    state.observe(seen, F.count("*").alias("lines"), F.count_if(bad).alias("quarantined")).write.mode("overwrite").partitionBy("state").parquet(f"{out}/lines")
    return spark.read.schema(state.schema).parquet(f"{out}/lines"), {"lines_read": seen.get["lines"] - seen.get["quarantined"], "lines_quarantined": seen.get["quarantined"]}


def matrices_of(rank: str = "", tier: str = "", with_abs: bool = True) -> dict[str, str]:
    return {kind: sinks.matrix_name(kind, rank, tier) for kind in (MATRIX_TYPES if with_abs else MATRIX_TYPES[:2])}


def run_aggregate(spark: SparkSession, a: argparse.Namespace) -> None:
    lines, counted = parsed_once(spark, a.reports, a.out)
    read = lines.where("state = 'read'").drop("state", "problem", "value")
    rows = aggregate.latest_reports(read)
    if not counted["lines_read"]:
        raise ValueError("no report has a row that can be read")
    readers.problems(lines.where("state = 'quarantine'")).write.mode("overwrite").parquet(f"{a.out}/problems")
    errors = readers.failed_files(readers.files_of(spark, a.reports), read)
    label = aggregate.labels(rows, a.min_reads)
    summaries = readers.read_summaries(spark, a.idxstats) if a.idxstats else None
    totals = summaries.select("sample_id", "total_reads") if a.idxstats else None
    nodes_at, names_at = a.nodes, a.names
    if a.db_path:
        nodes_at, names_at = nodes_at or readers.tree_file(spark, a.db_path, "nodes.dmp"), names_at or readers.tree_file(spark, a.db_path, "names.dmp")
    nodes = readers.read_nodes(spark, nodes_at) if nodes_at else None
    known = label
    if nodes is not None:
        lineage = taxonomy.closure(nodes).cache()
        known = aggregate.known_labels(label, nodes, readers.read_names(spark, names_at) if names_at else None)
    every = aggregate.samples(rows, totals, a.min_reads)
    told = every if summaries is None else reporting.provenance(every.drop("total_reads"), summaries)
    told.write.mode("overwrite").parquet(f"{a.out}/samples")
    kept = spark.read.parquet(f"{a.out}/samples")
    direct = kept.select("sample_id", "direct_total")
    whole = aggregate.measures(aggregate.counts(rows, a.min_reads), direct, totals).withColumn("rank_scope", F.lit("all"))
    clades = aggregate.measures(aggregate.counts(rows, a.min_reads, "clade_reads"), direct, totals)
    of_rank = aggregate.of_ranks(clades, label, [x for x in a.rank_filter if x != "S"])
    species = aggregate.of_ranks(whole.drop("rank_scope"), label, [x for x in a.rank_filter if x == "S"])
    cells = whole.unionByName(of_rank).unionByName(species).withColumn("tier", F.lit(SENSITIVE))
    tiers: dict[str, float] = {}
    if a.outputs and nodes is not None and not a.no_confidence_tiers:
        reads = confidence.last_outputs(readers.read_outputs(spark, a.outputs))
        found = confidence.read_confidence(reads.withColumn("assigned", F.col("tax_id")), lineage, "sample_id", "read_id", "assigned")
        # reports are the cohort: an output of a sample without one is not read
        found = found.join(kept.select("sample_id"), "sample_id", "left_semi").cache()
        for_tiers = confidence.tiers(found, a.confidence_threshold)
        tiers = {tier_suffix(x): x for x in sorted(set(a.confidence_threshold) - {0.0})}
        of_tiers = confidence.tier_samples(direct, for_tiers, list(tiers))
        cells = cells.unionByName(confidence.tier_cells(for_tiers, of_tiers, lineage, known, a.rank_filter, a.min_reads, totals))
        confidence.demoted(found, a.confidence_threshold).write.mode("overwrite").parquet(f"{a.out}/demoted")
        of_tiers.write.mode("overwrite").parquet(f"{a.out}/tier_samples")
        # reports of each tier, as the classifier would have written them; outputs without a read are in them
        records = confidence.tier_records(for_tiers, lineage)
        empty = confidence.without_reads(readers.samples_of_outputs(spark, a.outputs).join(kept.select("sample_id"), "sample_id", "left_semi"), for_tiers, list(tiers))
        records.unionByName(empty).write.mode("overwrite").partitionBy("tier").parquet(f"{a.out}/tier_reports")
    sinks.write_long(cells, f"{a.out}/cells")
    written = spark.read.parquet(f"{a.out}/cells")
    used = known.join(written.select("tax_id").unionByName(label.select("tax_id")).distinct(), "tax_id", "left_semi")
    if nodes is not None:
        used = used.join(taxonomy.domains(used, lineage), "tax_id", "left")
    used.write.mode("overwrite").parquet(f"{a.out}/labels")
    label, first = spark.read.parquet(f"{a.out}/labels"), written.where(f"tier = '{SENSITIVE}'")
    with_abs = totals is not None
    doc = aggregate.document(kept, first.where("rank_scope = 'all'"), errors, a.min_reads, a.rank_filter, matrices_of(with_abs=with_abs), nodes is not None, counted)
    if tiers:
        facts = aggregate.tier_facts(spark.read.parquet(f"{a.out}/tier_samples"), written, spark.read.parquet(f"{a.out}/demoted"), tiers, lambda x: matrices_of("", x, with_abs))
        doc = doc.join(F.broadcast(facts))
    sinks.write_json(doc, f"{a.out}/aggregation_metadata.json")
    sinks.write_lines(aggregate.rank_facts(first, a.min_reads, a.rank_filter, lambda r: matrices_of(r, "", with_abs)), f"{a.out}/rank_filter_metadata.json")
    if a.wide:
        samples = [x[0] for x in kept.select("sample_id").orderBy("sample_id").collect()]  # the columns of a wide file
        known_totals = kept.select("sample_id", "total_reads")
        for tier, scope in sorted(tuple(x) for x in written.select("tier", "rank_scope").distinct().collect()):  # one a file
            part = written.where((F.col("tier") == tier) & (F.col("rank_scope") == scope))
            for kind, name in matrices_of("" if scope == "all" else scope, "" if tier == SENSITIVE else tier, with_abs).items():
                sinks.write_matrix(part, label, kind, samples, f"{a.out}/{name}", known_totals)
    if nodes is not None:
        spark.catalog.clearCache()


def passes(spark: SparkSession, a: argparse.Namespace) -> list[tuple[str, str, str, str]]:
    """(folder, tier, rank, measure) of each pass: the primary one, then its ranks,
    tiers and, with totals, the abs sibling with its tiers."""
    cells, samples = spark.read.parquet(f"{a.cohort}/cells"), spark.read.parquet(f"{a.cohort}/samples")
    there = {(r["tier"], r["rank_scope"]) for r in cells.select("tier", "rank_scope").distinct().collect()}
    tiers = [r["tier"] for r in readers.tiers_found(cells.where("rank_scope = 'all'")).collect()] if not a.no_confidence_tiers else []
    out = [("", SENSITIVE, "all", a.matrix_type)] + [(r, SENSITIVE, r, a.matrix_type) for r in a.rank_filter if (SENSITIVE, r) in there] + [(x, x, "all", a.matrix_type) for x in tiers]
    if a.matrix_type != "abs" and not a.no_abs_detection and not samples.where("total_reads IS NOT NULL").isEmpty():
        out += [("abs", SENSITIVE, "all", "abs"), *((f"abs/{x}", x, "all", "abs") for x in tiers)]
    return out


#: The pass whose files are in no folder of their own.
PRIMARY = "primary"


def run_detect(spark: SparkSession, a: argparse.Namespace) -> None:
    cells, labels = spark.read.parquet(f"{a.cohort}/cells"), spark.read.parquet(f"{a.cohort}/labels")
    n, wanted = spark.read.parquet(f"{a.cohort}/samples").count(), passes(spark, a)
    value = lambda m: F.col("raw").cast("double") if m == "raw" else F.round(F.coalesce(F.col(m), F.lit(0.0)), 4)
    of = [F.when((F.col("tier") == tier) & (F.col("rank_scope") == rank), F.struct(F.lit(folder or PRIMARY).alias("pass"), value(measure).alias("value"))) for folder, tier, rank, measure in wanted]
    rows = cells.select("sample_id", "tax_id", F.explode(F.filter(F.array(*of), lambda p: p.isNotNull())).alias("p")).select("p.pass", "sample_id", "tax_id", "p.value")
    found = detect.search(rows, n, a.method, a.mad_threshold, a.iqr_multiplier, a.gmm_threshold, a.kitome_taxa, not a.no_subtract_background, by=("pass",))
    found.write.mode("overwrite").partitionBy("pass").parquet(f"{a.out}/found")  # all passes, from one reading of the cells
    found = spark.read.schema(found.schema).parquet(f"{a.out}/found").withColumn("method", F.col("method"))
    counted = detect.summaries(found, n, ("pass",)).withColumn("method", F.lit(a.method)).cache()
    for folder, _, _, measure in wanted:  # what people read of each pass, from its flags
        part = found.where(F.col("pass") == (folder or PRIMARY))
        summary = counted.where(F.col("pass") == (folder or PRIMARY)).drop("pass").withColumn("matrix_type", F.lit(measure))
        sinks.write_detection(detect.flags(part, labels), summary, f"{a.out}/{folder}".rstrip("/"))
    counted.unpersist()


def run_summary(spark: SparkSession, a: argparse.Namespace) -> None:
    meta = spark.read.json(f"{a.cohort}/aggregation_metadata.json").select("sample_count", "taxon_count")
    found = reporting.pipeline_summary(meta, spark.read.json(f"{a.flags}/qc_summary.json"), readers.read_flags(spark, f"{a.flags}/flagged_samples.tsv"))
    sinks.write_table(found, f"{a.out}/pipeline_summary.tsv")
    document = report.multiqc(found.withColumn("timestamp", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")).first().asDict())
    sinks.write_text(spark, document, f"{a.out}/pipeline_mqc.yaml")


def run_extraction(spark: SparkSession, a: argparse.Namespace) -> None:
    summaries = readers.read_summaries(spark, a.idxstats)
    found = reporting.extraction(summaries, readers.read_fastq_counts(spark, a.fastq), summaries)
    sinks.write_table(found.orderBy("sample_id"), f"{a.out}/extraction_summary.tsv")
    stats = summaries.select("sample_id", F.explode("per_chromosome").alias("c")).select("sample_id", "c.*")
    sinks.write_table(stats.orderBy("sample_id", "chrom"), f"{a.out}/idxstats.tsv")


def run_report(spark: SparkSession, a: argparse.Namespace) -> None:
    label, samples = spark.read.parquet(f"{a.cohort}/labels"), spark.read.parquet(f"{a.cohort}/samples")
    cells = spark.read.parquet(f"{a.cohort}/cells")
    named = label.select("tax_id", "name", *(["domain"] if "domain" in label.columns else []))
    fact = cells.where(f"tier = '{SENSITIVE}' AND rank_scope = 'all'").join(named, "tax_id", "left")
    if "domain" not in fact.columns:
        fact = fact.withColumn("domain", F.lit(None).cast("string"))
    fact, n = fact.cache(), samples.count()
    flags = readers.read_flags(spark, f"{a.flags}/flagged_samples.tsv")
    tiers = [r["tier"] for r in readers.tiers_found(cells.where("rank_scope = 'all'")).collect()]
    by_tier = None
    for tier in tiers:  # as many as there were thresholds; a tier without flags is left out
        part = readers.read_flags(spark, f"{a.flags}/{tier}/flagged_samples.tsv").select(F.lit(tier).alias("tier"), "sample_id")
        by_tier = part if by_tier is None else by_tier.unionByName(part)
    parts = report.sections(fact, n, flags, a.threshold_ppm, readers.read_flags(spark, f"{a.flags}/abs/flagged_samples.tsv"), by_tier, named, a.cluster_method)
    species = cohort.species(fact, n, flags)
    pages = [report.render("Cohort report", parts), report.manifest(species, flags, n, tiers)]
    for name, text in zip(("report_html", "manifest_json"), pages, strict=True):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(f"{a.out}/{name}")
    fields = cohort.species_fields(fact, n, named, flags, readers.read_flags(spark, f"{a.flags}/abs/flagged_samples.tsv"))
    sinks.write_table(fields.orderBy(F.desc_nulls_last("cohort_burden_ppm"), F.desc("cohort_raw_total"), "tax_id"), f"{a.out}/species_summary.tsv")
    stats = cohort.sample_stats(fact)
    sinks.write_table(stats.orderBy("sample_id"), f"{a.out}/per_sample_summary.tsv")
    sinks.write_table(cohort.over_threshold(stats, a.threshold_ppm).orderBy(F.desc("abs_ppm"), "sample_id"), f"{a.out}/variant_impact_flagged.tsv")
    for tier in tiers:  # a page for each tier, of that tier's cells and flags
        part = cells.where((F.col("tier") == tier) & F.expr("rank_scope = 'all'")).join(named, "tax_id", "left")
        part = part if "domain" in part.columns else part.withColumn("domain", F.lit(None).cast("string"))
        mine = report.sections(part, n, readers.read_flags(spark, f"{a.flags}/{tier}/flagged_samples.tsv"), a.threshold_ppm, readers.read_flags(spark, f"{a.flags}/abs/{tier}/flagged_samples.tsv"), None, named)
        sinks.write_text(spark, report.render(f"Cohort report, {tier}", mine), f"{a.out}/{tier}/report_html")


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tallytree {a.command}").getOrCreate()
    try:
        {"aggregate": run_aggregate, "detect": run_detect, "report": run_report, "summary": run_summary, "extraction": run_extraction}[a.command](spark, a)
    except (ValueError, OSError) as e:
        print(f"tallytree: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
