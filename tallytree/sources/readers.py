"""Typed tables from the text files that classifiers and aligners leave."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RANK_CODES, SUMMARY


def line_order() -> Column:
    """The place of a line in its file: the block's first byte, then the line's number. The
    order holds within a file of one split; parsing itself never depends on it."""
    return (F.col("_metadata.file_block_start") * 1000 + F.monotonically_increasing_id() % (1 << 33)).alias("line_ord")


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``value``, ``source_path``, ``line_ord`` of each line."""
    return spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source_path"), line_order())


def file_name(path: str = "source_path") -> Column:
    return F.element_at(F.split(F.col(path), "/"), -1)


def sample_of_report(name: Column) -> Column:
    return F.when(name.endswith(".kraken2.report.txt"), F.regexp_replace(name, r"\.kraken2\.report\.txt$", "")).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


def sample_of_output(name: Column) -> Column:
    return F.when(name.endswith(".kraken2.output.txt"), F.regexp_replace(name, r"\.kraken2\.output\.txt$", "")).otherwise(F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""))


#: Why a line can't be read.
FEW_FIELDS, BAD_NUMBER = "too few fields", "a number that can't be read"
REPORT_FIELDS = (("percentage", "double"), ("clade_reads", "long"), ("direct_reads", "long"), ("rank", "string"), ("tax_id", "long"), ("name", "string"))


def checked_report(rows: DataFrame) -> DataFrame:
    """Report lines (``value`` and any other columns) as typed rows, each with its
    ``problem``: null where it can be read, and ``value`` is then null, too. Blank
    lines and comments are no lines."""
    cells = rows.where((F.trim("value") != "") & ~F.ltrim("value").startswith("#")).withColumn("c", F.split(F.col("value"), "\t"))
    others = [c for c in rows.columns if c != "value"]
    field = lambda i, kind: F.trim(F.get("c", F.lit(i))) if kind == "string" else F.trim(F.get("c", F.lit(i))).try_cast(kind)
    typed = cells.select(*others, "value", F.size("c").alias("fields"), *(field(i, kind).alias(name) for i, (name, kind) in enumerate(REPORT_FIELDS)))
    bad = F.greatest(*(F.col(name).isNull() for name, kind in REPORT_FIELDS if kind != "string"))
    problem = F.when(F.col("fields") < len(REPORT_FIELDS), FEW_FIELDS).when(bad, BAD_NUMBER)
    told = typed.withColumn("problem", problem)
    return told.withColumn("value", F.when(F.col("problem").isNotNull(), F.col("value"))).select(*others, *(name for name, _ in REPORT_FIELDS), "problem", "value")


def parse_report(rows: DataFrame) -> DataFrame:
    """Report lines (``value`` and any other columns) as typed rows. Blank
    lines, comments, lines of fewer than six fields or with bad numbers go."""
    return checked_report(rows).where("problem IS NULL").drop("problem", "value")


def problems(checked: DataFrame) -> DataFrame:
    """``source_path``, ``problem``, ``lines``, and the first such line (``first_line``, ``example``)."""
    bad = checked.where("problem IS NOT NULL").groupBy("source_path", "problem")
    return bad.agg(F.count("*").alias("lines"), F.min(F.struct("line_ord", "value")).alias("at")).select("source_path", "problem", "lines", F.col("at.line_ord").alias("first_line"), F.col("at.value").alias("example"))


def files_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``source_path`` of every file, also of one without a line; nothing is read of them.
    The driver has this list whenever Spark reads the files."""
    return spark.createDataFrame([(x,) for x in spark.read.text(paths).inputFiles()], "source_path string")


def failed_files(files: DataFrame, rows: DataFrame) -> DataFrame:
    """``file`` and ``error`` of files (source_path) of which no row (source_path) could be read."""
    # a file without a host is written with one slash or with three
    alike = F.regexp_replace("source_path", "^([a-z0-9]+):///", "$1:/").alias("at")
    none = files.select("source_path", alike).distinct().join(rows.select(alike).distinct(), "at", "left_anti")
    return none.select(F.col("source_path").alias("file"), F.lit("no row that can be read").alias("error"))


def read_checked(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All lines of reports with their problems; what of a file can't be decoded is no line."""
    rows = spark.read.option("ignoreCorruptFiles", "true").text(paths)
    checked = checked_report(rows.select("value", F.col("_metadata.file_path").alias("source_path"), line_order()))
    return checked.select(sample_of_report(file_name()).alias("sample_id"), *checked.columns)


def read_reports(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    parsed = parse_report(lines(spark, paths))
    return parsed.select(sample_of_report(file_name()).alias("sample_id"), "source_path", "line_ord", "percentage", "clade_reads", "direct_reads", "rank", "tax_id", "name")


def parse_reads(rows: DataFrame) -> DataFrame:
    """Per-read lines as typed rows; fewer than five fields or a bad id go."""
    others = [c for c in rows.columns if c != "value"]
    cut = rows.withColumn("c", F.split(F.col("value"), "\t")).where(F.size("c") >= 5)
    c = F.col("c")
    typed = cut.select(*others, F.trim(c[0]).alias("status"), F.trim(c[1]).alias("read_id"), F.trim(c[2]).try_cast("long").alias("tax_id"), F.trim(c[3]).alias("length"), F.trim(c[4]).alias("kmers"))
    return typed.dropna(subset=["tax_id"])


def read_outputs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    parsed = parse_reads(lines(spark, paths))
    return parsed.select(sample_of_output(file_name()).alias("sample_id"), "source_path", "status", "read_id", "tax_id", "length", "kmers")


def samples_of_outputs(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``sample_id`` of every per-read output, also of one without a line."""
    return files_of(spark, paths).select(sample_of_output(file_name()).alias("sample_id")).distinct()


def parse_nodes(rows: DataFrame) -> DataFrame:
    cells = F.split(F.col("value"), r"\t\|\t?")
    code = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in RANK_CODES.items() for x in pair)), F.trim(F.col("c")[2])), F.lit("-"))
    return rows.withColumn("c", cells).where(F.size("c") >= 3).select(F.trim(F.col("c")[0]).try_cast("long").alias("tax_id"), F.trim(F.col("c")[1]).try_cast("long").alias("parent_id"), code.alias("rank")).dropna(subset=["tax_id", "parent_id"])


def parse_names(rows: DataFrame) -> DataFrame:
    c = F.col("c")
    cut = rows.withColumn("c", F.split(F.col("value"), r"\t?\|\t?")).where((F.size("c") >= 4) & (F.trim(c[3]) == "scientific name"))
    return cut.select(F.trim(c[0]).try_cast("long").alias("tax_id"), F.trim(c[1]).alias("name")).dropna(subset=["tax_id"])


def tree_file(spark: SparkSession, database: str, name: str) -> str:
    """Where a database folder has a file of the tree: in ``taxonomy``, else beside it."""
    tried = [f"{database}/taxonomy/{name}", f"{database}/{name}"]
    for path in tried:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            return path
    raise FileNotFoundError(f"no {' and no '.join(tried)}")


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return parse_nodes(spark.read.text(path))


def read_names(spark: SparkSession, path: str) -> DataFrame:
    return parse_names(spark.read.text(path))


def read_summaries(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Read totals; documents without sample_id or total_reads go; of several
    for one sample the one whose path sorts last counts."""
    return last_summaries(parse_summaries(spark.read.text(paths, wholetext=True).select("value", F.col("_metadata.file_path").alias("source_path"))))


def parse_summaries(rows: DataFrame) -> DataFrame:
    """Documents (``value``, one each) as typed rows; what is no such document goes."""
    doc = rows.select("source_path", F.from_json("value", SUMMARY).alias("d")).select("source_path", "d.*")
    return doc.where("sample_id IS NOT NULL AND total_reads IS NOT NULL")


def last_summaries(rows: DataFrame) -> DataFrame:
    return last_of(rows, ["sample_id"], "source_path")


def parse_idxstats(rows: DataFrame) -> DataFrame:
    """``chrom``, ``length``, ``mapped``, ``unmapped`` of index statistics lines."""
    c = F.col("c")
    others = [x for x in rows.columns if x != "value"]
    cut = rows.withColumn("c", F.split(F.col("value"), "\t")).where(F.size("c") >= 4)
    return cut.select(*others, c[0].alias("chrom"), *(c[i].try_cast("long").alias(n) for i, n in ((1, "length"), (2, "mapped"), (3, "unmapped")))).dropna(subset=["mapped", "unmapped"])


def fastq_counts(rows: DataFrame) -> DataFrame:
    """``source_path``, ``reads``: four lines a read; what is left over is no read."""
    return rows.groupBy("source_path").agg(F.floor(F.count("*") / 4).alias("reads"))


def read_fastq_counts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``sample_id``, ``source_path`` and ``reads`` of FASTQ files, packed ones too; what of
    a file can't be unpacked isn't counted. One without a line has 0 reads."""
    rows = spark.read.option("ignoreCorruptFiles", "true").text(paths).select(F.col("_metadata.file_path").alias("source_path"))
    alike = lambda df: df.withColumn("source_path", F.regexp_replace("source_path", "^([a-z0-9]+):///", "$1:/"))
    every = alike(files_of(spark, paths)).join(fastq_counts(alike(rows)), "source_path", "left")
    return every.select(sample_of_fastq(file_name()).alias("sample_id"), "source_path", F.coalesce("reads", F.lit(0).cast("long")).alias("reads"))


def sample_of_fastq(name: Column) -> Column:
    """Up to the mate, or to the first dot."""
    return F.regexp_extract(name, r"^(.+?)(?:[._](?:R?[12]|unmapped|singleton|other|interleaved|reads)\b.*|\..*)$", 1)


#: A tier's suffix, with the two decimals of its threshold.
TIER = r"conf(\d+)p(\d+)$"


def tiers_found(cells: DataFrame) -> DataFrame:
    """``tier``, ``threshold`` of the tiers that cells (tier, raw, cpm) hold in both
    measures, in order of their thresholds; names of another form are no tiers."""
    whole, part = F.regexp_extract("tier", TIER, 1), F.regexp_extract("tier", TIER, 2)
    both = cells.groupBy("tier").agg(F.count("raw").alias("raw"), F.count("cpm").alias("cpm")).where("raw > 0 AND cpm > 0")
    return both.where(whole != "").select("tier", F.concat_ws(".", whole, part).cast("double").alias("threshold")).orderBy("threshold", "tier")


def read_totals(stats: DataFrame) -> DataFrame:
    sums = stats.groupBy("sample_id").agg(F.sum("mapped").alias("total_mapped"), F.sum("unmapped").alias("total_unmapped"))
    return sums.withColumn("total_reads", F.col("total_mapped") + F.col("total_unmapped"))


#: Secondary, duplicate and supplementary alignments.
EXCLUDED, UNMAPPED = 0xD00, 0x4


def extracted(alignments: DataFrame, mapq: int | None = None) -> DataFrame:
    """Reads (flag, mapq) to classify: unmapped, or mapped under ``mapq``."""
    wanted = F.col("flag").bitwiseAND(UNMAPPED) != 0
    if mapq is not None:
        wanted |= F.col("mapq") < mapq
    return alignments.where(wanted & (F.col("flag").bitwiseAND(EXCLUDED) == 0))


def last_of(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Of rows with equal keys, the one that is last in ``order``; aggregated
    before it shuffles, so that no key's rows meet in one task."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, *(F.col("r")[c].alias(c) for c in rest))


FLAG_ROWS = "sample_id string, tax_id long, taxon_name string, value double, population_median double, deviation double, method string"


def read_flags(spark: SparkSession, path: str) -> DataFrame:
    """A detection's flags; no rows where the pass wasn't run."""
    try:
        return spark.read.schema(FLAG_ROWS).csv(path, sep="\t", header=True)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], FLAG_ROWS)


def read_matrix(spark: SparkSession, path: str, missing: float | None = None) -> DataFrame:
    """A wide matrix file as long rows (tax_id, name, [domain], sample_id,
    value). ``missing`` replaces NA and bad cells: 0.0 for detection, null for reports."""
    wide = spark.read.csv(path, sep="\t", header=True)
    fixed = [c for c in wide.columns[:3] if c in ("tax_id", "name", "domain")]
    long = wide.unpivot(fixed, [c for c in wide.columns if c not in fixed], "sample_id", "cell")
    value = F.col("cell").try_cast("double")
    return long.withColumn("tax_id", F.col("tax_id").try_cast("long")).where("tax_id IS NOT NULL").select(*fixed, "sample_id", (value if missing is None else F.coalesce(value, F.lit(missing))).alias("value"))
