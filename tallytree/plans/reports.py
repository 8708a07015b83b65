"""Queries of what a report shows, and of tiers end to end; registered by the catalog."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scratch
from ..operators import aggregate, cohort, confidence, detect, ordination, reporting
from ..sources import readers, sinks
from ..streaming import arrivals
from . import tables as t
from .catalog import CONFIDENCE_SQL, cells, confident, flagged, merge_sql, query, rounded, species_of, tiered

THRESHOLDS = [0.1, 0.5, 0.8]
TIERS = ["conf0p10", "conf0p50", "conf0p80"]
#: A sample whose per-read output is missing.
LOST = "Brand#2"


def stats_of(spark: SparkSession, d: str) -> DataFrame:
    return cohort.sample_stats(t.fact(spark, d))


# samples

@query(", kept AS (SELECT sample_id, count(*) AS cells FROM counts WHERE raw >= 30 GROUP BY 1) SELECT d.sample_id, CAST(direct_total AS BIGINT) AS direct_total, coalesce(cells, 0) AS cells, total_reads FROM direct d LEFT JOIN kept k ON d.sample_id = k.sample_id LEFT JOIN totals t ON d.sample_id = t.sample_id")
def cohort_samples(spark: SparkSession, d: str) -> DataFrame:
    """At this many reads some samples lose all cells; they stay samples."""
    rows = t.counts(spark, d).select("sample_id", "tax_id", F.col("raw").alias("direct_reads"), F.lit(0).alias("line_ord"))
    return aggregate.samples(rows, t.read_totals(spark, d), 30)


@query("SELECT sample_id, total_reads, total_mapped, 'lines of ' || sample_id AS input FROM (SELECT DISTINCT sample_id FROM counts) LEFT JOIN (SELECT sample_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_reads, count(*) FILTER (l_returnflag <> 'N') AS total_mapped FROM reads WHERE sample_id <> 'Brand#1' GROUP BY 1) s USING (sample_id)".replace("'lines of ' || sample_id", "CASE WHEN total_reads IS NOT NULL THEN 'lines of ' || sample_id END"))
def sample_provenance(spark: SparkSession, d: str) -> DataFrame:
    """Documents written from the line items and parsed again, of all samples but one."""
    sums = t.reads(spark, d).where(F.col("sample_id") != t.UNTOLD).groupBy("sample_id").agg(F.sum(F.col("l_quantity").cast("long")).alias("total_reads"), F.count_if(F.col("l_returnflag") != "N").alias("total_mapped"))
    document = F.to_json(F.struct("sample_id", F.concat(F.lit("lines of "), "sample_id").alias("input"), "total_reads", "total_mapped"))
    said = readers.parse_summaries(sums.select(F.col("sample_id").alias("source_path"), document.alias("value")))
    return reporting.provenance(t.counts(spark, d).select("sample_id").distinct(), said).select("sample_id", "total_reads", "total_mapped", "input")


@query("SELECT sample_id, CASE WHEN total_reads IS NULL THEN 'FAILED' ELSE 'OK' END AS status, coalesce(total_reads * 2, 0) AS read_count, total_reads FROM (SELECT DISTINCT sample_id FROM counts) LEFT JOIN totals USING (sample_id)")
def extraction_batch(spark: SparkSession, d: str) -> DataFrame:
    done = t.read_totals(spark, d).withColumn("read_count", F.col("total_reads") * 2)
    return reporting.batch(t.counts(spark, d), done)


@query(", f AS (SELECT sample_id, l_returnflag, count(*) // 4 AS reads FROM reads WHERE sample_id NOT LIKE 'Brand#2%' GROUP BY ALL), g AS (SELECT sample_id, CAST(sum(reads) AS BIGINT) AS n, string_agg(sample_id || '_' || l_returnflag, ';' ORDER BY l_returnflag) AS files FROM f GROUP BY 1) SELECT s.sample_id, CASE WHEN t.total_reads IS NOT NULL THEN 'lines of ' || s.sample_id END AS input, CASE WHEN g.n IS NULL THEN 'FAILED' ELSE 'OK' END AS status, coalesce(g.n, 0) AS read_count, m.total_mapped, CAST(t.total_reads - m.total_mapped AS BIGINT) AS total_unmapped, CAST(t.total_reads AS BIGINT) AS total_reads, coalesce(files, '') AS output_files FROM (SELECT DISTINCT sample_id FROM counts) s LEFT JOIN g ON g.sample_id = s.sample_id LEFT JOIN totals t ON t.sample_id = s.sample_id LEFT JOIN (SELECT sample_id, count(*) FILTER (l_returnflag <> 'N') AS total_mapped FROM reads WHERE sample_id <> 'Brand#1' GROUP BY 1) m ON m.sample_id = s.sample_id")
def extraction_summary(spark: SparkSession, d: str) -> DataFrame:
    """Line items as lines of FASTQ files, one a return flag; some samples have none."""
    lines = t.reads(spark, d).where("sample_id NOT LIKE 'Brand#2%'").select("sample_id", F.concat_ws("_", "sample_id", "l_returnflag").alias("source_path"))
    files = readers.fastq_counts(lines.select("source_path")).join(lines.distinct(), "source_path")
    sums = t.reads(spark, d).where(F.col("sample_id") != t.UNTOLD).groupBy("sample_id").agg(F.sum(F.col("l_quantity").cast("long")).alias("total_reads"), F.count_if(F.col("l_returnflag") != "N").alias("total_mapped"))
    said = sums.select("sample_id", F.concat(F.lit("lines of "), "sample_id").alias("input"), "total_reads", "total_mapped", (F.col("total_reads") - F.col("total_mapped")).alias("total_unmapped"), F.lit(None).cast("string").alias("extraction_time"))
    return reporting.extraction(t.counts(spark, d).select("sample_id").distinct(), files, said)


@query("SELECT l_linestatus AS source_path, count(*) // 4 AS reads FROM lineitem GROUP BY 1", shared=False)
def fastq_counts(spark: SparkSession, d: str) -> DataFrame:
    return readers.fastq_counts(t.table(spark, d, "lineitem").select(F.col("l_linestatus").alias("source_path"), F.lit("line").alias("value")))


@query("SELECT (SELECT samples FROM n) AS sample_count, (SELECT count(DISTINCT tax_id) FROM counts WHERE raw >= 3) AS taxon_count, 3 AS min_reads, true AS absolute_burden_enabled, (SELECT string_agg(sample_id, ',' ORDER BY sample_id) FROM direct WHERE sample_id NOT IN (SELECT sample_id FROM totals)) AS samples_without_totals")
def aggregation_metadata(spark: SparkSession, d: str) -> DataFrame:
    rows = t.counts(spark, d).select("sample_id", "tax_id", F.col("raw").alias("direct_reads"), F.lit(0).alias("line_ord"))
    return aggregate.metadata(aggregate.samples(rows, t.read_totals(spark, d), 3), aggregate.counts(rows, 3), 3)


# what can't be read, names, wide files, a run's counts

SPOILT_SQL = """, said AS (SELECT sample_id, tax_id, raw, CASE WHEN sample_id = 'Brand#13' THEN '1\t2\t3' WHEN raw % 5 = 2 THEN concat('1.0\t', raw, '\ttwo\tS\t', tax_id, '\tx') WHEN raw % 5 = 3 THEN concat('1.0\t', raw, '\t', raw) END AS bad FROM counts)
"""


def spoilt_reports(spark: SparkSession, d: str) -> DataFrame:
    """Counts as report lines: a report without a good line, bad numbers, lines that end early, comments."""
    raw, tax = F.col("raw").cast("string"), F.col("tax_id").cast("string")
    line = lambda *cells_: F.concat_ws("\t", *(F.lit(c) if isinstance(c, str) else c for c in cells_))
    value = F.when(F.col("sample_id") == "Brand#13", line("1", "2", "3")).when(F.col("raw") % 5 == 2, line("1.0", raw, "two", "S", tax, "x")).when(F.col("raw") % 5 == 3, line("1.0", raw, raw)).when(F.col("raw") % 5 == 4, line("  # note")).otherwise(line("1.0", raw, raw, "S", tax, "x"))
    return readers.checked_report(t.counts(spark, d).select(F.col("sample_id").alias("source_path"), F.col("tax_id").alias("line_ord"), value.alias("value")))


@query(SPOILT_SQL + "SELECT sample_id AS source_path, CASE WHEN sample_id = 'Brand#13' OR raw % 5 = 3 THEN 'too few fields' ELSE 'a number that can''t be read' END AS problem, count(*) AS lines, min(tax_id) AS first_line, arg_min(bad, tax_id) AS example FROM said WHERE bad IS NOT NULL GROUP BY ALL")
def report_problems(spark: SparkSession, d: str) -> DataFrame:
    return readers.problems(spoilt_reports(spark, d))


@query("SELECT sample_id AS file, 'no row that can be read' AS error FROM counts GROUP BY 1 HAVING sample_id = 'Brand#13' OR count(*) FILTER (raw % 5 IN (0, 1)) = 0")
def failed_reports(spark: SparkSession, d: str) -> DataFrame:
    checked = spoilt_reports(spark, d)
    return readers.failed_files(checked, checked.where("problem IS NULL"))


@query(", l AS (SELECT tax_id, 'reported ' || tax_id AS name, 'S' AS rank FROM counts GROUP BY 1 HAVING tax_id % 2 = 0) SELECT coalesce(l.tax_id, n.tax_id) AS tax_id, coalesce(l.name, n.name) AS name, coalesce(l.rank, n.rank) AS rank, false AS inconsistent FROM l FULL JOIN nodes n ON l.tax_id = n.tax_id")
def known_labels(spark: SparkSession, d: str) -> DataFrame:
    """What reports say of labels comes first; the tree names the others, ancestors among them."""
    label = t.counts(spark, d).where("tax_id % 2 = 0").select("tax_id").distinct().select("tax_id", F.concat(F.lit("reported "), F.col("tax_id").cast("string")).alias("name"), F.lit("S").alias("rank"), F.lit(False).alias("inconsistent"))
    tree = t.nodes(spark, d)
    return aggregate.known_labels(label, tree.select("tax_id", "parent_id", "rank"), tree.select("tax_id", "name"))


@query("SELECT concat(g.tax_id, '\t', any_value(coalesce(name, '')), '\t', string_agg(CASE WHEN g.sample_id NOT IN (SELECT sample_id FROM totals) THEN 'NA' ELSE printf('%.4f', coalesce(abs, 0)) END, '\t' ORDER BY g.sample_id)) AS value FROM grid g LEFT JOIN measured m ON m.tax_id = g.tax_id AND m.sample_id = g.sample_id LEFT JOIN nodes ON nodes.tax_id = g.tax_id GROUP BY g.tax_id")
def wide_lines(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the wide file of abs, without its heads."""
    found = t.measured(spark, d)
    samples = sorted(r[0] for r in found.select("sample_id").distinct().collect())  # the columns
    totals = found.select("sample_id").distinct().join(t.read_totals(spark, d), "sample_id", "left")
    return sinks.wide_lines(found, t.nodes(spark, d).select("tax_id", "name"), "abs", samples, totals).where("value NOT LIKE 'tax\\_id%'")


@query("SELECT (SELECT samples FROM n) AS samples, (SELECT count(DISTINCT tax_id) FROM counts) AS taxa_in_matrix, 'mad' AS detection_method, (SELECT count(*) FROM flags) AS flagged_pairs, (SELECT count(DISTINCT sample_id) FROM flags) AS quarantined_samples")
def pipeline_summary(spark: SparkSession, d: str) -> DataFrame:
    rows = t.counts(spark, d).select("sample_id", "tax_id", F.col("raw").alias("direct_reads"), F.lit(0).alias("line_ord"))
    meta = aggregate.metadata(aggregate.samples(rows, t.read_totals(spark, d)), aggregate.counts(rows), 0)
    c = cells(spark, d)
    n = t.sample_count(c)
    found = detect.search(c, n, "mad", mad_threshold=2.0)
    return reporting.pipeline_summary(meta, detect.summaries(found, n).withColumn("method", F.lit("mad")), detect.flags(found, t.nodes(spark, d)))


def arrived(spark: SparkSession, d: str) -> str:
    """The counts as reports in three batches: all samples, then a third of them again with
    later reports of two more reads a label, then a few with earlier ones, which don't count."""
    folder = f"{scratch.folder(spark)}/{uuid.uuid4().hex}"
    rows = t.counts(spark, d).select("sample_id", F.lit("b").alias("source_path"), F.lit(0).alias("line_ord"), "tax_id", F.col("raw").alias("direct_reads"))
    later, early = rows.where("sample_id LIKE 'Brand#1%'"), rows.where("sample_id LIKE 'Brand#%2'")
    arrivals.take_in(rows, 0, folder)
    arrivals.take_in(later.withColumn("source_path", F.lit("c")).withColumn("direct_reads", F.col("direct_reads") + 2).where("tax_id % 3 > 0"), 1, folder)
    arrivals.take_in(early.withColumn("source_path", F.lit("a")).withColumn("direct_reads", F.lit(99).cast("long")), 2, folder)
    return folder


ARRIVED_SQL = ", arrived AS (SELECT sample_id, tax_id, CASE WHEN sample_id LIKE 'Brand#1%' THEN raw + 2 ELSE raw END AS raw FROM counts WHERE sample_id NOT LIKE 'Brand#1%' OR tax_id % 3 > 0)"


@query(ARRIVED_SQL + " SELECT tax_id, CAST(sum(raw) AS BIGINT) AS raw_total, count(*) AS positives FROM arrived GROUP BY 1")
def incremental_sums(spark: SparkSession, d: str) -> DataFrame:
    """Sums of labels that followed batch by batch, replaced reports taken off."""
    return arrivals.snapshot(spark, f"{arrived(spark, d)}/sums", arrivals.SUMS).drop("batch")


@query(ARRIVED_SQL + " SELECT sample_id, CASE WHEN sample_id LIKE 'Brand#1%' THEN 'c' ELSE 'b' END AS source_path, CAST(sum(raw) AS BIGINT) AS direct_total, count(*) AS cells FROM arrived GROUP BY ALL")
def incremental_samples(spark: SparkSession, d: str) -> DataFrame:
    """Which report of each sample counts after the last batch, and its sums."""
    return arrivals.snapshot(spark, f"{arrived(spark, d)}/samples", arrivals.SAMPLES).drop("batch", "of_batch")


# tiers

TIER_SQL = CONFIDENCE_SQL + """, tcounts AS (SELECT x.tier, sample_id, CASE WHEN confidence >= x.t THEN greatest(tax_id, 0) ELSE 0 END AS tax_id, count(*) AS raw
  FROM conf, (VALUES ('conf0p10', 0.1), ('conf0p50', 0.5), ('conf0p80', 0.8)) x(tier, t) WHERE sample_id <> 'Brand#2' GROUP BY ALL),
tsamples AS (SELECT x.tier, d.sample_id, coalesce(own, direct_total) AS direct_total, own IS NOT NULL AS has_output FROM direct d, (VALUES ('conf0p10'), ('conf0p50'), ('conf0p80')) x(tier)
  LEFT JOIN (SELECT tier, sample_id, sum(raw) AS own FROM tcounts GROUP BY ALL) o ON o.tier = x.tier AND o.sample_id = d.sample_id)
"""


def tier_direct(spark: SparkSession, d: str) -> DataFrame:
    return tiered(confident(spark, d).where(F.col("sample_id") != LOST), THRESHOLDS)


def tier_samples_of(spark: SparkSession, d: str, direct: DataFrame) -> DataFrame:
    totals = aggregate.denominators(t.counts(spark, d).withColumnRenamed("raw", "direct_reads"))
    return confidence.tier_samples(totals, direct, TIERS)


@query(TIER_SQL + "SELECT tier, sample_id, CAST(direct_total AS BIGINT) AS direct_total, has_output FROM tsamples")
def missing_outputs(spark: SparkSession, d: str) -> DataFrame:
    """A sample without output keeps the sensitive total and stays in each tier."""
    return tier_samples_of(spark, d, tier_direct(spark, d))


@query(TIER_SQL + """, tclades AS (SELECT tier, sample_id, coalesce(l.ancestor_id, c.tax_id) AS tax_id, sum(raw) AS raw FROM tcounts c LEFT JOIN lineage l ON c.tax_id = l.tax_id GROUP BY ALL),
scoped AS (SELECT tier, 'all' AS rank_scope, sample_id, tax_id, raw FROM tcounts WHERE raw >= 2
  UNION ALL SELECT tier, n.rank, sample_id, c.tax_id, raw FROM tclades c JOIN nodes n ON c.tax_id = n.tax_id WHERE n.rank IN ('G', 'F') AND raw >= 2
  UNION ALL SELECT tier, n.rank, sample_id, c.tax_id, raw FROM tcounts c JOIN nodes n ON c.tax_id = n.tax_id WHERE n.rank = 'S' AND raw >= 2)
SELECT s.tier, rank_scope, s.sample_id, tax_id, CAST(raw AS BIGINT) AS raw, round(raw / direct_total * 1e6, 4) AS cpm, round(raw / total_reads * 1e6, 4) AS abs
FROM scoped s JOIN tsamples x ON s.tier = x.tier AND s.sample_id = x.sample_id LEFT JOIN totals t ON s.sample_id = t.sample_id""")
def tier_matrices(spark: SparkSession, d: str) -> DataFrame:
    direct = tier_direct(spark, d)
    rows = confidence.tier_cells(direct, tier_samples_of(spark, d, direct), t.lineage(spark, d), t.nodes(spark, d), ("S", "G", "F"), 2, t.read_totals(spark, d))
    return rounded(rows, "cpm", "abs", places=4)


@query(TIER_SQL + """, c AS (SELECT tc.tier, raw, CASE WHEN raw % 2 = 0 THEN raw / direct_total * 1e6 END AS cpm FROM tcounts tc JOIN tsamples s ON tc.tier = s.tier AND tc.sample_id = s.sample_id WHERE tc.tier <> 'conf0p50' OR raw % 2 = 1)
SELECT tier, CAST(regexp_extract(tier, 'conf(\\d+)p(\\d+)$', 1) || '.' || regexp_extract(tier, 'conf(\\d+)p(\\d+)$', 2) AS DOUBLE) AS threshold FROM c GROUP BY tier HAVING count(raw) > 0 AND count(cpm) > 0""")
def tiers_found(spark: SparkSession, d: str) -> DataFrame:
    """Tiers with both measures: odd counts have no CPM here, and one tier only odd counts."""
    direct = tier_direct(spark, d)
    found = direct.join(tier_samples_of(spark, d, direct), ["tier", "sample_id"])
    rows = found.select("tier", F.col("direct_reads").alias("raw"), F.when(F.col("direct_reads") % 2 == 0, F.col("direct_reads") / F.col("direct_total") * 1e6).alias("cpm"))
    sensitive = t.measured(spark, d).select(F.lit("sensitive").alias("tier"), "raw", "cpm")
    return readers.tiers_found(rows.where("tier <> 'conf0p50' OR raw % 2 = 1").unionByName(sensitive))


@query(TIER_SQL + """, tl AS (SELECT DISTINCT tier, tax_id FROM tcounts), tg AS (SELECT tl.tier, tl.tax_id, s.sample_id, coalesce(raw, 0) AS raw FROM tl CROSS JOIN (SELECT sample_id FROM direct) s LEFT JOIN tcounts c ON c.tier = tl.tier AND c.tax_id = tl.tax_id AND c.sample_id = s.sample_id),
tm AS (SELECT tier, tax_id, median(raw) AS med FROM tg GROUP BY ALL), td AS (SELECT g.tier, g.tax_id, any_value(med) AS med, median(abs(raw - med)) AS mad FROM tg g JOIN tm ON g.tier = tm.tier AND g.tax_id = tm.tax_id GROUP BY ALL),
tf AS (SELECT DISTINCT g.tier, sample_id FROM tg g JOIN td ON g.tier = td.tier AND g.tax_id = td.tax_id WHERE mad <> 0 AND raw > med AND abs(raw - med) / (1.4826 * mad) > 2.0), base AS (SELECT DISTINCT sample_id FROM flags)
SELECT tier, count(*) AS flagged, count(b.sample_id) AS shared, (SELECT count(*) FROM base) - count(b.sample_id) AS sensitive_only, count(*) - count(b.sample_id) AS tier_only FROM tf LEFT JOIN base b ON tf.sample_id = b.sample_id GROUP BY 1""")
def tier_concordance(spark: SparkSession, d: str) -> DataFrame:
    """Detection in each tier, held against detection on all reads."""
    rows = tier_direct(spark, d).select("tier", "sample_id", "tax_id", F.col("direct_reads").alias("value"))
    found = detect.search(rows, t.sample_count(t.counts(spark, d)), "mad", mad_threshold=2.0, by=("tier",)).where("method IS NOT NULL")
    return reporting.flag_agreement(flagged(spark, d, method="mad", mad_threshold=2.0), found)


@query(CONFIDENCE_SQL + "SELECT x.tier, sample_id, count(*) FILTER (tax_id > 0 AND confidence < x.t) AS demoted FROM conf, (VALUES ('conf0p10', 0.1), ('conf0p50', 0.5), ('conf0p80', 0.8)) x(tier, t) GROUP BY ALL")
def demoted_reads(spark: SparkSession, d: str) -> DataFrame:
    return confidence.demoted(confident(spark, d), THRESHOLDS)


@query("SELECT x.tier, sample_id, 0::BIGINT AS tax_id, 0::BIGINT AS direct_reads, 0::BIGINT AS clade_reads, 0.0::DOUBLE AS percentage FROM (VALUES ('conf0p10'), ('conf0p50'), ('conf0p80')) x(tier), direct WHERE sample_id IN ('Brand#1', 'Brand#2')")
def outputs_without_reads(spark: SparkSession, d: str) -> DataFrame:
    direct = t.counts(spark, d).where(~F.col("sample_id").isin("Brand#1", "Brand#2")).select("sample_id", "tax_id", F.col("raw").alias("direct_reads"))
    return confidence.without_reads(t.counts(spark, d), direct, TIERS)


@query("SELECT o_custkey % 40 AS sample_id, o_orderpriority AS source_path, count(*) AS lines FROM orders WHERE (o_custkey % 40, o_orderpriority) IN (SELECT (o_custkey % 40, max(o_orderpriority)) FROM orders GROUP BY o_custkey % 40) GROUP BY 1, 2", shared=False)
def last_outputs(spark: SparkSession, d: str) -> DataFrame:
    """Of several outputs of a sample the last one counts."""
    rows = t.table(spark, d, "orders").select((F.col("o_custkey") % 40).alias("sample_id"), F.col("o_orderpriority").alias("source_path"))
    return confidence.last_outputs(rows).groupBy("sample_id", "source_path").agg(F.count("*").alias("lines"))


@query(""", halves AS (SELECT tax_id, list_sort(list(v)) AS x, count(*) AS k FROM centred GROUP BY tax_id), q AS (SELECT tax_id, list_median(x[1:greatest(k // 2, 1)]) AS q1, list_median(x[k - greatest(k // 2, 1) + 1:k]) AS q3 FROM halves)
SELECT (SELECT count(*) FROM mad WHERE mad = 0) AS taxa_skipped_mad_zero, (SELECT count(*) FROM q WHERE q3 = q1) AS taxa_skipped_iqr_zero""")
def detection_counters(spark: SparkSession, d: str) -> DataFrame:
    c = cells(spark, d)
    return detect.skipped(c, t.sample_count(c))


# sections

@query(", p AS (SELECT tax_id, prevalence, abs_median AS level FROM species WHERE abs_median > 0 AND prevalence > 0), m AS (SELECT x[len(x) // 2 + 1] AS middle FROM (SELECT list_sort(list(level)) AS x FROM p)) SELECT tax_id, round(prevalence, 6) AS prevalence, round(level, 4) AS level, CASE WHEN prevalence >= 0.5 AND level >= middle THEN 'systemic burden' WHEN prevalence >= 0.5 THEN 'core kitome' WHEN level >= middle THEN 'outburst' ELSE 'trace' END AS quadrant FROM p, m")
def prevalence_quadrants(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(reporting.quadrants(species_of(spark, d)), "prevalence"), "level", places=4)


@query("SELECT tax_id, round(prevalence, 6) AS prevalence, round(cpm_median, 4) AS cpm_median, round(cpm_p95, 4) AS cpm_p95 FROM (SELECT * FROM species ORDER BY burden DESC NULLS LAST, raw_total DESC, tax_id LIMIT 200) WHERE cpm_median > 0")
def prevalence_scatter(spark: SparkSession, d: str) -> DataFrame:
    return rounded(rounded(reporting.scatter(species_of(spark, d)), "prevalence"), "cpm_median", "cpm_p95", places=4)


@query(", s AS (SELECT sample_id, domain, sum(cpm) AS cpm FROM fact WHERE tax_id <> 9606 AND cpm > 0 GROUP BY ALL) SELECT domain, count(*) AS samples, round(quantile_cont(cpm, 0.05), 4) AS q05, round(quantile_cont(cpm, 0.25), 4) AS q25, round(median(cpm), 4) AS median, round(quantile_cont(cpm, 0.75), 4) AS q75, round(quantile_cont(cpm, 0.95), 4) AS q95 FROM s GROUP BY 1")
def burden_by_domain(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reporting.burden_by_domain(t.fact(spark, d)), "q05", "q25", "median", "q75", "q95", places=4)


@query(", x AS (SELECT 'richness' AS measure, CAST(richness AS DOUBLE) AS v FROM stats), e AS (SELECT min(v) AS lo, CASE WHEN max(v) <= min(v) THEN min(v) + 1 ELSE max(v) END AS hi FROM x), h AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, count(*) AS n FROM x, e GROUP BY 1) SELECT 'richness' AS measure, CAST(b AS INT) AS bin, coalesce(n, 0) AS n FROM range(20) r(b) LEFT JOIN h ON h.bin = r.b")
def richness_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reporting.diversity(stats_of(spark, d)).where("measure = 'richness'")


@query(", x AS (SELECT 'richness' AS measure, CAST(richness AS DOUBLE) AS v FROM stats UNION ALL SELECT 'shannon', round(shannon, 9) FROM stats), e AS (SELECT measure, min(v) AS lo, CASE WHEN max(v) <= min(v) THEN min(v) + 1 ELSE max(v) END AS hi FROM x GROUP BY 1), h AS (SELECT x.measure, CAST(least(floor((v - lo) / ((hi - lo) / 20)), 19) AS INT) AS bin, count(*) AS n FROM x JOIN e ON x.measure = e.measure GROUP BY ALL) SELECT e.measure, CAST(b AS INT) AS bin, coalesce(n, 0) AS n FROM e, range(20) r(b) LEFT JOIN h ON h.bin = r.b AND h.measure = e.measure")
def diversity_histograms(spark: SparkSession, d: str) -> DataFrame:
    """Of values with nine digits, so that a value on an edge falls where it falls in SQL."""
    return reporting.diversity(rounded(stats_of(spark, d), "shannon", places=9))


@query(""", f AS (SELECT DISTINCT sample_id FROM flags), pct AS (SELECT *, (classified - human) / classified * 100 AS pct FROM stats),
lists AS (SELECT 'burden' AS list, sample_id, abs_ppm AS v FROM pct WHERE abs_ppm IS NOT NULL UNION ALL SELECT 'composition', sample_id, pct FROM pct UNION ALL SELECT 'diversity', sample_id, shannon FROM pct UNION ALL SELECT 'flagged', sample_id, coalesce(abs_ppm, 0) FROM pct WHERE sample_id IN (SELECT sample_id FROM f))
SELECT list, sample_id, rank FROM (SELECT list, sample_id, CAST(row_number() OVER (PARTITION BY list ORDER BY v DESC, sample_id) AS INT) AS rank FROM lists) WHERE rank <= 15""")
def notable_samples(spark: SparkSession, d: str) -> DataFrame:
    return reporting.notable(stats_of(spark, d), flagged(spark, d, method="mad", mad_threshold=2.0))


@query("SELECT tax_id, CAST(sum(raw) AS BIGINT) AS raw_total, round(sum(cpm) / any_value(samples), 4) AS mean_cpm, round(sum(coalesce(abs, 0)) / any_value(samples), 4) AS mean_abs FROM measured, n GROUP BY tax_id ORDER BY raw_total DESC, tax_id LIMIT 10")
def cohort_means(spark: SparkSession, d: str) -> DataFrame:
    m = t.measured(spark, d)
    return rounded(reporting.means(m, t.sample_count(m)), "mean_cpm", "mean_abs", places=4)


@query("SELECT domain, CAST(row_number() OVER (ORDER BY CASE domain WHEN 'Bacteria' THEN 1 WHEN 'Viruses' THEN 2 WHEN 'Fungi' THEN 3 WHEN 'Archaea' THEN 4 ELSE 9 END, domain) AS INT) AS place FROM (SELECT DISTINCT domain FROM domains WHERE domain <> '')")
def domain_legend(spark: SparkSession, d: str) -> DataFrame:
    return reporting.legend(t.domains(spark, d))


@query("SELECT sample_id, domain, round(sum(cpm), 4) AS cpm FROM fact WHERE tax_id <> 9606 AND sample_id IN (SELECT sample_id FROM flags) GROUP BY ALL")
def flagged_domain_cpm(spark: SparkSession, d: str) -> DataFrame:
    rows = reporting.only_flagged(t.fact(spark, d), flagged(spark, d, method="mad", mad_threshold=2.0))
    return rounded(cohort.domain_cpm(rows), "cpm", places=4)


@query(", told AS (SELECT band, row_number() OVER (PARTITION BY band ORDER BY burden DESC NULLS LAST, raw_total DESC, tax_id) AS rank, tax_id FROM species WHERE band = 'core' OR (band = 'rare' AND burden > 0)) SELECT band, CAST(told.rank AS INT) AS rank, coalesce(name, '') AS name FROM told LEFT JOIN nodes ON told.tax_id = nodes.tax_id WHERE told.rank <= 3")
def discussion_species(spark: SparkSession, d: str) -> DataFrame:
    return reporting.discussion(species_of(spark, d), t.nodes(spark, d))


TOP_SQL = ", top AS (SELECT tax_id FROM species WHERE tax_id NOT IN (0, 1) ORDER BY burden DESC NULLS LAST, raw_total DESC, tax_id LIMIT 20), tg AS (SELECT * FROM grid WHERE tax_id IN (SELECT tax_id FROM top))"


def top_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the labels that a heat map shows."""
    return cells(spark, d).join(F.broadcast(reporting.leading(species_of(spark, d), 20).select("tax_id")), "tax_id", "left_semi")


@query(TOP_SQL + ", p AS (SELECT x.tax_id AS a, y.tax_id AS b, sum(abs(x.raw - y.raw)) / sum(x.raw + y.raw) AS bray_curtis, count(*) FILTER (x.raw > 0 AND y.raw > 0) AS met FROM tg x JOIN tg y ON x.sample_id = y.sample_id AND x.tax_id < y.tax_id GROUP BY ALL) SELECT a, b, round(bray_curtis, 6) AS bray_curtis FROM p WHERE met > 0")
def species_distances(spark: SparkSession, d: str) -> DataFrame:
    """Labels against each other, over the samples."""
    turned = top_cells(spark, d).select(F.col("tax_id").alias("sample_id"), F.col("sample_id").alias("tax_id"), "value")
    return rounded(ordination.pairwise(turned).select("a", "b", "bray_curtis"), "bray_curtis")


@query(TOP_SQL + ", p AS (SELECT x.sample_id AS a, y.sample_id AS b, sum(abs(x.raw - y.raw)) / sum(x.raw + y.raw) AS bray_curtis, count(*) FILTER (x.raw > 0 AND y.raw > 0) AS met FROM tg x JOIN tg y ON x.tax_id = y.tax_id AND x.sample_id < y.sample_id GROUP BY ALL) SELECT a, b, round(bray_curtis, 6) AS bray_curtis FROM p WHERE met > 0")
def heat_map_distances(spark: SparkSession, d: str) -> DataFrame:
    """Samples against each other, over the informative labels of most burden."""
    return rounded(ordination.pairwise(top_cells(spark, d)).select("a", "b", "bray_curtis"), "bray_curtis")


@query(""", q AS (SELECT tax_id, quantile_cont(abs, 0.75) - quantile_cont(abs, 0.25) AS iqr, quantile_cont(abs, 0.95) AS p95 FROM fact WHERE tax_id <> 9606 GROUP BY 1),
lg AS (SELECT tax_id, log10(cpm) AS x FROM measured), e AS (SELECT tax_id, min(x) AS lo, CASE WHEN max(x) <= min(x) THEN 1 ELSE max(x) - min(x) END / 12 AS w FROM lg GROUP BY 1),
h AS (SELECT lg.tax_id, CAST(least(floor((x - lo) / w), 11) AS INT) AS bin, count(*) AS n FROM lg JOIN e ON e.tax_id = lg.tax_id GROUP BY ALL), sp AS (SELECT s.tax_id, string_agg(coalesce(n, 0), ',' ORDER BY b) AS sparkline FROM species s CROSS JOIN range(12) r(b) LEFT JOIN h ON h.tax_id = s.tax_id AND h.bin = r.b GROUP BY 1),
fp AS (SELECT tax_id, count(DISTINCT sample_id) AS n FROM flags GROUP BY 1), fa AS (SELECT tax_id, count(DISTINCT sample_id) AS n FROM flags WHERE deviation > 3 GROUP BY 1)
SELECT s.tax_id, coalesce(name, CAST(s.tax_id AS VARCHAR)) AS name, coalesce(domain, 'Unannotated') AS domain, round(prevalence, 6) AS prevalence, round(prevalence_at_min, 6) AS prevalence_at_min, positives AS positives_n, 5 AS min_reads_for_prevalence,
  round(cpm_median, 4) AS cpm_median_pos, round(cpm_iqr, 4) AS cpm_iqr_pos, round(cpm_p95, 4) AS cpm_p95_pos, round(abs_median, 4) AS abs_median_pos, round(iqr, 4) AS abs_iqr_pos, round(p95, 4) AS abs_p95_pos, raw_total AS cohort_raw_total, round(burden, 4) AS cohort_burden_ppm,
  coalesce(fp.n, 0) AS n_flagged_primary, coalesce(fa.n, 0) AS n_flagged_abs, round(robust_cv, 6) AS cv_robust, sparkline
FROM species s JOIN q ON q.tax_id = s.tax_id JOIN sp ON sp.tax_id = s.tax_id LEFT JOIN nodes ON nodes.tax_id = s.tax_id LEFT JOIN domains d ON d.tax_id = s.tax_id LEFT JOIN fp ON fp.tax_id = s.tax_id LEFT JOIN fa ON fa.tax_id = s.tax_id""")
def species_table(spark: SparkSession, d: str) -> DataFrame:
    """All nineteen fields of a label."""
    fact = t.fact(spark, d)
    labels = t.nodes(spark, d).select("tax_id", "name").join(t.domains(spark, d), "tax_id", "left")
    unnamed = fact.select("tax_id", F.lit(None).cast("string").alias("name"), "domain").distinct().join(labels, "tax_id", "left_anti")
    flags = flagged(spark, d, method="mad", mad_threshold=2.0)
    rows = cohort.species_fields(fact, t.sample_count(fact), labels.unionByName(unnamed), flags, flags.where("deviation > 3"))
    return rounded(rounded(rows, "prevalence", "prevalence_at_min", "cv_robust"), "cpm_median_pos", "cpm_iqr_pos", "cpm_p95_pos", "abs_median_pos", "abs_iqr_pos", "abs_p95_pos", "cohort_burden_ppm", places=4)


@query(", f AS (SELECT tax_id, CAST(row_number() OVER (ORDER BY burden DESC NULLS LAST, raw_total DESC, tax_id) AS INT) AS place FROM species WHERE tax_id NOT IN (0, 1) QUALIFY place <= 25) SELECT place, m.tax_id, CAST(row_number() OVER (PARTITION BY m.tax_id ORDER BY raw DESC, sample_id) AS INT) AS rank, sample_id, raw, round(cpm, 4) AS cpm, round(abs, 4) AS abs FROM measured m JOIN f ON f.tax_id = m.tax_id QUALIFY rank <= 10")
def drill_down(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reporting.drill_down(t.fact(spark, d), species_of(spark, d)), "cpm", "abs", places=4)


@query(", x AS (SELECT log10(round(abs_ppm, 6)) AS v FROM stats WHERE abs_ppm > 0), e AS (SELECT min(v) AS lo, CASE WHEN max(v) <= min(v) THEN min(v) + 1 ELSE max(v) END AS hi FROM x), h AS (SELECT CAST(least(floor((v - lo) / ((hi - lo) / 30)), 29) AS INT) AS bin, count(*) AS n FROM x, e GROUP BY 1) SELECT CAST(b AS INT) AS bin, coalesce(n, 0) AS n FROM range(30) r(b) LEFT JOIN h ON h.bin = r.b")
def burden_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reporting.burden_histogram(rounded(stats_of(spark, d), "abs_ppm"))


@query(", g AS (SELECT domain, CAST(sum(raw) AS BIGINT) AS reads FROM fact WHERE tax_id <> 9606 GROUP BY 1) SELECT domain, reads, round(reads / (SELECT sum(reads) FROM g), 6) AS share FROM g")
def domain_mix(spark: SparkSession, d: str) -> DataFrame:
    return rounded(reporting.domain_mix(t.fact(spark, d)), "share")


@query(", one AS (SELECT DISTINCT sample_id FROM flags), two AS (SELECT sample_id FROM stats WHERE abs_ppm > 38500) SELECT 'flags, mad' AS what, count(*) AS n FROM flags HAVING count(*) > 0 UNION ALL SELECT 'samples, mad', count(*) FROM one HAVING count(*) > 0 UNION ALL SELECT CASE WHEN one.sample_id IS NOT NULL AND two.sample_id IS NOT NULL THEN 'samples, both passes' WHEN one.sample_id IS NOT NULL THEN 'samples, primary pass alone' ELSE 'samples, abs pass alone' END, count(*) FROM one FULL JOIN two ON one.sample_id = two.sample_id GROUP BY 1")
def detection_overview(spark: SparkSession, d: str) -> DataFrame:
    over = cohort.over_threshold(stats_of(spark, d), 38500.0)
    return reporting.detection_overview(flagged(spark, d, method="mad", mad_threshold=2.0), over)


SPECIES_PAIRS_SQL = TOP_SQL + ", p0 AS MATERIALIZED (SELECT x.tax_id AS a, y.tax_id AS b, sum(abs(x.raw - y.raw)) / sum(x.raw + y.raw) AS d FROM tg x JOIN tg y ON x.sample_id = y.sample_id AND x.tax_id < y.tax_id GROUP BY ALL)"


def species_tree(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = top_cells(spark, d)
    turned = rows.select(F.col("tax_id").alias("sample_id"), F.col("sample_id").alias("tax_id"), "value")
    pairs = ordination.pairwise(turned).select("a", "b", F.col("bray_curtis").alias("distance"))
    return ordination.linkage(rows.select(F.col("tax_id").alias("item")).distinct(), pairs)


@query(SPECIES_PAIRS_SQL + merge_sql("p") + "SELECT CAST(place AS INT) AS place, item AS tax_id, round(height, 6) AS height FROM pleaves")
def species_clusters(spark: SparkSession, d: str) -> DataFrame:
    """The labels of the heat map in the order of their tree."""
    _, leaves = species_tree(spark, d)
    return rounded(leaves.select(F.col("place").cast("int").alias("place"), F.col("item").alias("tax_id"), "height"), "height")


@query(SPECIES_PAIRS_SQL + merge_sql("p") + ", q0 AS MATERIALIZED (SELECT x.sample_id AS a, y.sample_id AS b, sum(abs(x.raw - y.raw)) / sum(x.raw + y.raw) AS d FROM tg x JOIN tg y ON x.tax_id = y.tax_id AND x.sample_id < y.sample_id GROUP BY ALL)" + merge_sql("q") + "SELECT CAST(r.place AS INT) AS row, CAST(c.place AS INT) AS column, m.tax_id, m.sample_id, round(abs, 4) AS value FROM measured m JOIN pleaves r ON r.item = m.tax_id JOIN qleaves c ON c.item = m.sample_id WHERE abs > 0")
def abs_heat_map(spark: SparkSession, d: str) -> DataFrame:
    """Burden, rows in the order of the labels' tree and columns in that of the samples'."""
    rows = top_cells(spark, d)
    _, down = species_tree(spark, d)
    pairs = ordination.pairwise(rows).select("a", "b", F.col("bray_curtis").alias("distance"))
    _, across = ordination.linkage(rows.select(F.col("sample_id").alias("item")).distinct(), pairs)
    burden = cells(spark, d, "abs").where("value > 0")
    return rounded(ordination.heat_map(burden, down, across), "value", places=4)
