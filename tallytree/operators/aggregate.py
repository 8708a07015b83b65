"""Cohort counts: denominators, named measures, labels, dense matrices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import checked_ranks
from ..sources.readers import last_of


def latest_reports(rows: DataFrame) -> DataFrame:
    """Of samples with several reports, the one whose path sorts last."""
    last = rows.groupBy("sample_id").agg(F.max("source_path").alias("source_path"))
    return rows.join(last, ["sample_id", "source_path"], "left_semi")


def denominators(rows: DataFrame) -> DataFrame:
    """``sample_id``, ``direct_total``: all direct reads before any filter, the
    unclassified and the root's among them."""
    return rows.groupBy("sample_id").agg(F.sum("direct_reads").alias("direct_total"))


def counts(rows: DataFrame, min_reads: int = 0, column: str = "direct_reads") -> DataFrame:
    """Sparse counts; cells under ``min_reads`` are left out. Of lines that
    repeat a label the last counts."""
    one = last_of(rows.select("sample_id", "tax_id", column, "line_ord"), ["sample_id", "tax_id"], "line_ord")
    return one.where(F.col(column) >= min_reads).select("sample_id", "tax_id", F.col(column).alias("raw"))


def labels(rows: DataFrame, min_reads: int = 0) -> DataFrame:
    """``tax_id``, ``name``, ``rank`` (of the last row that passes), and whether
    samples disagree on them."""
    order = F.struct("source_path", "line_ord")
    kept = rows.where(F.col("direct_reads") >= min_reads)
    return kept.groupBy("tax_id").agg(F.max_by("name", order).alias("name"), F.max_by("rank", order).alias("rank"), ((F.min("name") != F.max("name")) | (F.min("rank") != F.max("rank"))).alias("inconsistent"))


def measures(cells: DataFrame, direct_totals: DataFrame, read_totals: DataFrame | None = None) -> DataFrame:
    """Adds ``cpm`` (of all direct reads; 0 if there are none) and ``abs`` (per
    million of everything sequenced; null where that isn't known or not over 0)."""
    out = cells.join(direct_totals, "sample_id", "left")
    out = out.withColumn("cpm", F.when(F.col("direct_total") > 0, F.col("raw") / F.col("direct_total") * 1e6).otherwise(0.0))
    if read_totals is None:
        return out.withColumn("abs", F.lit(None).cast("double")).drop("direct_total")
    totals = read_totals.select("sample_id", F.when(F.col("total_reads") > 0, F.col("total_reads")).alias("all_reads"))
    return out.join(totals, "sample_id", "left").withColumn("abs", F.col("raw") / F.col("all_reads") * 1e6).drop("direct_total", "all_reads")


def of_ranks(cells: DataFrame, label: DataFrame, ranks: list[str] | tuple[str, ...]) -> DataFrame:
    """Cells of labels of the given ranks, with the rank as ``rank_scope``."""
    wanted = label.where(F.col("rank").isin(checked_ranks(ranks))).select("tax_id", F.col("rank").alias("rank_scope"))
    return cells.join(wanted, "tax_id")


def dense(cells: DataFrame, value: str = "raw") -> DataFrame:
    """Every label with every sample, missing cells 0: for the wide files alone;
    statistics work on the sparse cells and a weighted zero."""
    grid = cells.select("tax_id").distinct().crossJoin(cells.select("sample_id").distinct())  # the matrix itself
    return grid.join(cells.select("tax_id", "sample_id", value), ["tax_id", "sample_id"], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def samples(rows: DataFrame, read_totals: DataFrame | None = None, min_reads: int = 0) -> DataFrame:
    """Every sample that was parsed, also one without a cell that is left:
    ``sample_id``, ``direct_total``, ``cells`` (labels with ``min_reads`` or more)
    and ``total_reads`` (null where not known)."""
    kept = counts(rows, min_reads).groupBy("sample_id").agg(F.count("*").alias("cells"))
    out = denominators(rows).join(kept, "sample_id", "left").withColumn("cells", F.coalesce("cells", F.lit(0)))
    if read_totals is None:
        return out.withColumn("total_reads", F.lit(None).cast("long"))
    return out.join(read_totals.select("sample_id", "total_reads"), "sample_id", "left")


def metadata(every: DataFrame, cells: DataFrame, min_reads: int) -> DataFrame:
    """One row that says what was aggregated: of samples (``samples``' result) how
    many, those without read totals by name, of cells how many labels."""
    names = F.array_join(F.sort_array(F.collect_list(F.when(F.col("total_reads").isNull(), F.col("sample_id")))), ",")
    s = every.agg(F.count("*").alias("sample_count"), (F.count("total_reads") > 0).alias("absolute_burden_enabled"), names.alias("samples_without_totals"))
    taxa = cells.agg(F.countDistinct("tax_id").alias("taxon_count"))
    return s.join(F.broadcast(taxa)).select("sample_count", "taxon_count", F.lit(min_reads).alias("min_reads"), "absolute_burden_enabled", "samples_without_totals")


def known_labels(label: DataFrame, nodes: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """``tax_id``, ``name``, ``rank``, ``inconsistent`` of every label of the reports or of
    the tree: what the reports say comes first, then what the tree and its names say. So
    ancestors that no report has a row of are named, too."""
    tree = nodes.select("tax_id", F.col("rank").alias("tree_rank"))
    tree = tree.withColumn("tree_name", F.lit(None).cast("string")) if names is None else tree.join(names.groupBy("tax_id").agg(F.min("name").alias("tree_name")), "tax_id", "left")
    both = label.join(tree.dropDuplicates(["tax_id"]), "tax_id", "full")
    return both.select("tax_id", F.coalesce("name", "tree_name").alias("name"), F.coalesce("rank", "tree_rank").alias("rank"), F.coalesce("inconsistent", F.lit(False)).alias("inconsistent"))


def tier_facts(samples: DataFrame, cells: DataFrame, demoted: DataFrame, thresholds: dict[str, float], matrices: Callable[[str], dict[str, str]]) -> DataFrame:
    """One row, ``confidence_tiers``: of each tier its threshold, matrices, samples with
    and without output (``samples``: what ``tier_samples`` gives), reads demoted in each
    sample, and labels. Each is a list of samples, as is the document it goes into."""
    outputs = samples.groupBy("tier").agg(F.sort_array(F.collect_list(F.when(F.col("has_output"), F.col("sample_id")))).alias("samples_with_output"), F.sort_array(F.collect_list(F.when(~F.col("has_output"), F.col("sample_id")))).alias("samples_without_output"))
    low = demoted.groupBy("tier").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("sample_id", "demoted")))).alias("reads_demoted_to_unclassified"))
    taxa = cells.where("rank_scope = 'all'").groupBy("tier").agg(F.countDistinct("tax_id").alias("taxon_count"))
    rows = outputs.join(low, "tier", "left").join(taxa, "tier", "left")
    of = lambda value: F.element_at(F.create_map(*(x for t in thresholds for x in (F.lit(t), value(t)))), F.col("tier"))
    names = of(lambda t: F.create_map(*(F.lit(x) for kv in matrices(t).items() for x in kv)))
    entry = F.struct(of(lambda t: F.lit(float(thresholds[t]))).alias("threshold"), names.alias("matrix_paths"), "samples_with_output", "samples_without_output", "reads_demoted_to_unclassified", F.coalesce("taxon_count", F.lit(0).cast("long")).alias("taxon_count"))
    return rows.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col("tier"), F.to_json(entry).alias("facts"))))).alias("confidence_tiers"))


def document(every: DataFrame, cells: DataFrame, errors: DataFrame, min_reads: int, ranks: list[str], matrices: dict[str, str], with_domains: bool, lines: dict[str, int]) -> DataFrame:
    """``metadata`` with samples, provenance, files that failed (``errors``), matrices and
    how many lines were read and left out."""
    said = [c for c in ("total_reads", "total_mapped", "total_unmapped", "input", "extraction_time") if c in every.columns]
    names = F.sort_array(F.collect_list("sample_id")).alias("samples")
    told = F.map_from_entries(F.sort_array(F.collect_list(F.struct("sample_id", F.to_json(F.struct(*said), {"ignoreNullFields": "false"}).alias("said"))))).alias("sample_provenance")
    lists = every.agg(names, told).join(F.broadcast(errors.agg(F.sort_array(F.collect_list(F.struct("file", "error"))).alias("errors"))))
    fixed = [F.array(*map(F.lit, ranks)).alias("rank_filter"), F.create_map(*(F.lit(x) for kv in matrices.items() for x in kv)).alias("matrix_paths"), F.lit(with_domains).alias("domain_annotated"), *(F.lit(n).cast("long").alias(c) for c, n in lines.items())]
    return metadata(every, cells, min_reads).join(F.broadcast(lists)).select("*", *fixed)


def rank_facts(cells: DataFrame, min_reads: int, ranks: list[str], matrices: Callable[[str], dict[str, str]]) -> DataFrame:
    """``rank``, ``taxon_count`` and ``matrix_paths`` of each rank that was asked for."""
    n = cells.where(F.col("rank_scope") != "all").groupBy(F.col("rank_scope").alias("rank")).agg(F.countDistinct("tax_id").alias("taxon_count"))
    asked = cells.sparkSession.createDataFrame([(r, matrices(r)) for r in ranks], "rank string, matrix_paths map<string,string>")
    return asked.join(n, "rank", "left").select("rank", F.coalesce("taxon_count", F.lit(0).cast("long")).alias("taxon_count"), F.lit(min_reads).alias("min_reads"), "matrix_paths")


def without_totals(samples: DataFrame, read_totals: DataFrame) -> DataFrame:
    return samples.select("sample_id").distinct().join(read_totals, "sample_id", "left_anti")
