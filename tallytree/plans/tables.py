"""The driver's tables seen as a cohort: brands are samples, suppliers species,
nations genera, regions families; a line item is a read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import aggregate, taxonomy

#: A supplier that stands for the host, and a brand without read totals.
HOST, UNTOLD = 7, "Brand#1"
ANCHORS = ((1000, "Bacteria"), (1001, "Archaea"), (1002, "Viruses"))
EUKARYOTA, EUKARYOTES = 1003, ((9606, "Human"), (2003, "Fungi"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def species_id(key: str) -> Column:
    return F.when(F.col(key) == HOST, 9606).otherwise(F.col(key) + 10000).cast("long")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("sample_id"))
    makers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation"))
    label = F.when(F.col("l_returnflag") == "N", 0).otherwise(species_id("l_suppkey")).cast("long")
    return lines.join(parts, "l_partkey").join(makers, "l_suppkey").withColumn("tax_id", label)


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tax_id, parent_id, name, rank of the whole tree."""
    s = table(spark, sf_dir, "supplier").select(species_id("s_suppkey").alias("tax_id"), (F.col("s_nationkey") + 2000).cast("long").alias("parent_id"), F.col("s_name").alias("name"), F.lit("S").alias("rank"))
    n = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 2000).cast("long"), (F.col("n_regionkey") + 1000).cast("long"), "n_name", F.lit("G"))
    r = table(spark, sf_dir, "region").select((F.col("r_regionkey") + 1000).cast("long"), F.lit(1).cast("long"), "r_name", F.lit("F"))
    root = spark.range(1).select(F.lit(1).cast("long"), F.lit(1).cast("long"), F.lit("root"), F.lit("R"))
    return s.union(n).union(r).union(root)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cohort's cells, kept: statistics go over them several times, the reads are gone through once."""
    return reads(spark, sf_dir).groupBy("sample_id", "tax_id").agg(F.count("*").alias("raw")).persist()


def read_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = reads(spark, sf_dir).where(F.col("sample_id") != UNTOLD)
    return rows.groupBy("sample_id").agg(F.sum(F.col("l_quantity").cast("long")).alias("total_reads"))


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, tax_id, raw, cpm, abs."""
    cells = counts(spark, sf_dir)
    direct = aggregate.denominators(cells.withColumnRenamed("raw", "direct_reads"))
    return aggregate.measures(cells, direct, read_totals(spark, sf_dir))


def lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxonomy.closure(nodes(spark, sf_dir).select("tax_id", "parent_id"))


def domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = counts(spark, sf_dir).select("tax_id")
    return taxonomy.domains(labels, lineage(spark, sf_dir), ANCHORS, EUKARYOTA, EUKARYOTES)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measured(spark, sf_dir).join(domains(spark, sf_dir), "tax_id", "left")


def sample_count(cells: DataFrame) -> int:
    return cells.select("sample_id").distinct().count()


#: The same in DuckDB's SQL, put before each query's own.
SQL = """
WITH RECURSIVE reads AS MATERIALIZED (
  SELECT p_brand AS sample_id, l_orderkey, l_linenumber, l_quantity, s_nationkey AS nation, l_suppkey, l_returnflag,
         CAST(CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_suppkey = 7 THEN 9606 ELSE 10000 + l_suppkey END AS BIGINT) AS tax_id
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
nodes AS (
  SELECT CAST(CASE WHEN s_suppkey = 7 THEN 9606 ELSE 10000 + s_suppkey END AS BIGINT) AS tax_id, CAST(2000 + s_nationkey AS BIGINT) AS parent_id, s_name AS name, 'S' AS rank FROM supplier
  UNION ALL SELECT 2000 + n_nationkey, 1000 + n_regionkey, n_name, 'G' FROM nation
  UNION ALL SELECT 1000 + r_regionkey, 1, r_name, 'F' FROM region
  UNION ALL SELECT 1, 1, 'root', 'R'),
lineage AS (
  SELECT tax_id, tax_id AS ancestor_id, 0 AS depth FROM nodes
  UNION ALL SELECT l.tax_id, n.parent_id, l.depth + 1 FROM lineage l JOIN nodes n ON l.ancestor_id = n.tax_id WHERE n.parent_id <> n.tax_id),
counts AS (SELECT sample_id, tax_id, count(*) AS raw FROM reads GROUP BY sample_id, tax_id),
direct AS (SELECT sample_id, sum(raw) AS direct_total FROM counts GROUP BY sample_id),
totals AS (SELECT sample_id, sum(CAST(l_quantity AS BIGINT)) AS total_reads FROM reads WHERE sample_id <> 'Brand#1' GROUP BY sample_id),
measured AS (
  SELECT c.sample_id, tax_id, raw, raw / direct_total * 1e6 AS cpm, raw / total_reads * 1e6 AS abs
  FROM counts c JOIN direct d ON c.sample_id = d.sample_id LEFT JOIN totals t ON c.sample_id = t.sample_id),
ups AS (SELECT c.tax_id, list(ancestor_id) AS up FROM (SELECT DISTINCT tax_id FROM counts) c LEFT JOIN lineage l ON c.tax_id = l.tax_id GROUP BY c.tax_id),
domains AS (
  SELECT tax_id, CASE WHEN tax_id = 0 THEN 'Unclassified' WHEN list_contains(up, 1000) THEN 'Bacteria' WHEN list_contains(up, 1001) THEN 'Archaea'
    WHEN list_contains(up, 1002) THEN 'Viruses' WHEN list_contains(up, 1003) THEN CASE WHEN list_contains(up, 9606) THEN 'Human' WHEN list_contains(up, 2003) THEN 'Fungi' ELSE 'Protists' END
    ELSE 'Unclassified' END AS domain FROM ups),
fact AS (SELECT m.*, domain FROM measured m LEFT JOIN domains d ON m.tax_id = d.tax_id),
n AS (SELECT count(DISTINCT sample_id) AS samples FROM counts),
grid AS (
  SELECT t.tax_id, s.sample_id, coalesce(c.raw, 0) AS raw FROM (SELECT DISTINCT tax_id FROM counts) t CROSS JOIN (SELECT DISTINCT sample_id FROM counts) s
  LEFT JOIN counts c ON c.tax_id = t.tax_id AND c.sample_id = s.sample_id),
centred AS (SELECT tax_id, sample_id, raw - avg(raw) OVER (PARTITION BY tax_id) AS v FROM grid),
med AS (SELECT tax_id, median(v) AS med FROM centred GROUP BY tax_id),
mad AS (SELECT c.tax_id, any_value(med) AS med, median(abs(v - med)) AS mad FROM centred c JOIN med m ON c.tax_id = m.tax_id GROUP BY c.tax_id),
flags AS (
  SELECT sample_id, c.tax_id, v AS value, med AS population_median, abs(v - med) / (1.4826 * mad) AS deviation
  FROM centred c JOIN mad m ON c.tax_id = m.tax_id WHERE mad <> 0 AND v > med AND abs(v - med) / (1.4826 * mad) > 2.0),
stats AS (
  SELECT sample_id, CAST(sum(raw) AS BIGINT) AS classified, CAST(sum(CASE WHEN tax_id = 9606 THEN raw ELSE 0 END) AS BIGINT) AS human, sum(CASE WHEN tax_id <> 9606 THEN abs END) AS abs_ppm,
         count(*) AS richness, ln(sum(raw)) - sum(raw * ln(raw)) / sum(raw) AS shannon, 1 - sum(raw * raw) / (sum(raw) * sum(raw)) AS simpson
  FROM fact GROUP BY sample_id),
sp0 AS (
  SELECT tax_id, count(*) / any_value(samples) AS prevalence, count(*) FILTER (raw >= 5) / any_value(samples) AS prevalence_at_min, CAST(sum(raw) AS BIGINT) AS raw_total, sum(abs) AS burden, count(*) AS positives,
         median(cpm) AS cpm_median, quantile_cont(cpm, 0.75) - quantile_cont(cpm, 0.25) AS cpm_iqr, quantile_cont(cpm, 0.95) AS cpm_p95, median(abs) AS abs_median, max(cpm) AS cpm_max
  FROM fact, n WHERE tax_id <> 9606 GROUP BY tax_id),
species AS (
  SELECT s.*, CASE WHEN positives >= 2 AND cpm_median > 0 THEN m.mad / cpm_median END AS robust_cv, CASE WHEN prevalence >= 0.5 THEN 'core' WHEN prevalence >= 0.1 THEN 'accessory' ELSE 'rare' END AS band
  FROM sp0 s JOIN (SELECT f.tax_id, median(abs(f.cpm - s.cpm_median)) AS mad FROM fact f JOIN sp0 s ON f.tax_id = s.tax_id GROUP BY f.tax_id) m ON s.tax_id = m.tax_id)
"""
