"""Reports that arrive over time, as a stream of typed rows."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import aggregate
from ..sources.readers import file_name, last_of, parse_report, sample_of_report


def arriving_reports(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of report files that appear in a folder."""
    rows = spark.readStream.format("text").load(folder).select("value", F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_modification_time").alias("arrived"))
    parsed = parse_report(rows)
    return parsed.select(sample_of_report(file_name()).alias("sample_id"), *(c for c in parsed.columns))


def keep_counts(spark: SparkSession, folder: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Appends arriving rows to a table, once each, and stops when all that is
    there has been taken in. Per-sample statistics can follow each batch; what
    needs the whole cohort runs over the table."""
    rows = arriving_reports(spark, folder)
    return rows.writeStream.format("parquet").option("path", table_path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


#: What a cohort that grows keeps: rows as they came, and after each batch which report of a
#: sample counts, with its sums, and the sums of each label.
ROWS = "sample_id string, source_path string, tax_id long, raw long, batch long"
SAMPLES = "sample_id string, source_path string, direct_total long, cells long, of_batch long, batch long"
SUMS = "tax_id long, raw_total long, positives long, batch long"


def snapshot(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """The table as the last batch left it (the last one before a given batch); without
    rows where there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(path)
    done = rows.where(F.col("batch") < before) if before is not None else rows
    last = done.agg(F.max("batch")).first()[0]
    return rows.where(F.col("batch") == (-1 if last is None else last))


def take_in(rows: DataFrame, batch: int, folder: str) -> None:
    """Takes report rows (sample_id, source_path, line_ord, tax_id, direct_reads) into the
    cohort in ``folder``. Of a sample's reports the one whose path sorts last counts, in
    whatever batch it came; where it replaces an earlier one, that one's counts are taken
    off the labels' sums again. Only rows of this batch's samples are read.

    A batch writes partitions of its own and begins from those of the batch before, so one
    that is run again after a failure leaves the same. Null samples, labels and counts are
    left out; of lines that repeat a label the last counts; an empty batch changes nothing.
    """
    spark = rows.sparkSession
    good = rows.where("sample_id IS NOT NULL AND tax_id IS NOT NULL AND direct_reads IS NOT NULL")
    one = last_of(good.select("sample_id", "source_path", "tax_id", "direct_reads", "line_ord"), ["sample_id", "source_path", "tax_id"], "line_ord")
    one.select("sample_id", "source_path", "tax_id", F.col("direct_reads").alias("raw")).write.mode("overwrite").parquet(f"{folder}/rows/batch={batch}")
    every = spark.read.schema(ROWS).parquet(f"{folder}/rows")
    new, before = every.where(F.col("batch") == batch), snapshot(spark, f"{folder}/samples", SAMPLES, batch)
    said = aggregate.latest_reports(new).groupBy("sample_id", "source_path").agg(F.sum("raw").alias("direct_total"), F.count("*").alias("cells"))
    was = before.select(F.col("sample_id").alias("at"), F.col("source_path").alias("was_path"), F.col("of_batch").alias("was_batch"))
    won = said.join(was, F.col("sample_id") == F.col("at"), "left").where("was_path IS NULL OR source_path >= was_path").cache()
    stay = before.drop("batch").join(won.select("sample_id"), "sample_id", "left_anti")
    stay.unionByName(won.select(*said.columns, F.lit(batch).cast("long").alias("of_batch"))).write.mode("overwrite").parquet(f"{folder}/samples/batch={batch}")
    added = new.join(won, ["sample_id", "source_path"], "left_semi").select("tax_id", "raw", F.lit(1).cast("long").alias("sign"))
    replaced = won.where("was_path IS NOT NULL").select("sample_id", F.col("was_path").alias("source_path"), F.col("was_batch").alias("batch"))
    gone = every.join(replaced, ["sample_id", "source_path", "batch"], "left_semi").select("tax_id", "raw", F.lit(-1).cast("long").alias("sign"))
    change = added.unionByName(gone).groupBy("tax_id").agg(F.sum(F.col("raw") * F.col("sign")).alias("raw_total"), F.sum(F.when(F.col("raw") > 0, F.col("sign")).otherwise(0)).alias("positives"), F.sum("sign").alias("cells"))
    sums = snapshot(spark, f"{folder}/sums", SUMS, batch).drop("batch").unionByName(change.drop("cells"))
    whole = sums.groupBy("tax_id").agg(F.sum("raw_total").alias("raw_total"), F.sum("positives").alias("positives")).where("raw_total <> 0 OR positives <> 0")
    whole.write.mode("overwrite").parquet(f"{folder}/sums/batch={batch}")
    won.unpersist()


def current_cells(spark: SparkSession, folder: str) -> DataFrame:
    """``sample_id``, ``tax_id``, ``raw`` of the reports that count."""
    now = snapshot(spark, f"{folder}/samples", SAMPLES).select("sample_id", "source_path", F.col("of_batch").alias("batch"))
    return spark.read.schema(ROWS).parquet(f"{folder}/rows").join(now, ["sample_id", "source_path", "batch"], "left_semi").select("sample_id", "tax_id", "raw")


def keep_cohort(spark: SparkSession, reports: str, folder: str, checkpoint: str, files: int = 1000) -> StreamingQuery:
    """Takes report files as they appear into a growing cohort, so many a batch at most,
    and stops when all that are there have been taken in. A line's place holds within its file."""
    source = spark.readStream.format("text").option("maxFilesPerTrigger", files).load(reports)
    rows = source.select("value", F.col("_metadata.file_path").alias("source_path"))
    return rows.writeStream.foreachBatch(partial(into, folder)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def into(folder: str, rows: DataFrame, batch: int) -> None:
    parsed = parse_report(rows.withColumn("line_ord", F.monotonically_increasing_id()))
    take_in(parsed.withColumn("sample_id", sample_of_report(file_name())), batch, folder)
