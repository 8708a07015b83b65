"""Writers: long Parquet for engines, wide text matrices and flag lists for people."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FLAGS


def matrix_name(matrix_type: str, rank: str = "", tier: str = "") -> str:
    return "_".join(filter(None, ["taxa_matrix", matrix_type, rank, tier])) + ".tsv"


def write_long(cells: DataFrame, path: str) -> None:
    """The primary artefact: partitioned by what the names of wide files carry."""
    parts = [c for c in ("matrix_type", "rank_scope", "tier") if c in cells.columns]
    cells.write.mode("overwrite").partitionBy(*parts).parquet(path)


def quoted(text: str | None) -> str:
    """A cell of a text file: quoted only where it would be read as something else."""
    if not text:
        return ""
    return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"' if any(c in text for c in '\t\n\r"') else text


def wide_lines(cells: DataFrame, labels: DataFrame, value: str, samples: list[str], totals: DataFrame | None = None) -> DataFrame:
    """The wide matrix as lines of text (``value``): a line a label, a column a sample;
    counts whole, others with four decimals, unknown ones NA. A missing cell is 0; of
    ``abs`` it is NA where the sample (sample_id, total_reads) has no total to divide by.

    Cells are sorted by label and by their sample's place, and each task writes its
    labels' lines as it goes through them: it holds one line, however many samples there
    are, and nothing is pivoted. Each partition begins with the heads.
    """
    spark, whole = cells.sparkSession, dict(cells.dtypes)[value] in ("bigint", "int")
    text = F.col(value).cast("long").cast("string") if whole else F.format_string("%.4f", F.col(value).cast("double"))
    unknown: set[str] = set()
    if value == "abs" and totals is not None:
        unknown = {r[0] for r in totals.where("total_reads IS NULL OR total_reads <= 0").select("sample_id").collect()}  # of the columns' samples
    heads = [c for c in ("name", "domain") if c in labels.columns]
    empty = ["0" if whole else "NA" if s in unknown else "0.0000" for s in samples]
    first = "\t".join(quoted(c) for c in ("tax_id", *heads, *samples))
    places = spark.createDataFrame(pa.table({"sample_id": pa.array(samples, pa.string()), "at": pa.array(range(len(samples)), pa.int32())}))
    filled = cells.join(places, "sample_id").select("tax_id", "at", F.coalesce(F.when(F.col(value).isNotNull(), text), F.lit("NA")).alias("text"))
    names = labels.select("tax_id", F.lit(-1).alias("at"), F.to_json(F.array(*(F.coalesce(h, F.lit("")) for h in heads))).alias("text"))
    merged = filled.unionByName(names).repartitionByRange("tax_id").sortWithinPartitions("tax_id", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tax_id, own, line, some, out, size = None, [""] * len(heads), [], False, [first], 0

        def done() -> None:
            nonlocal size
            if some:
                out.append("\t".join([str(tax_id), *map(quoted, own), *line]))
                size += len(out[-1])

        for b in batches:
            for t, at, cell in zip(*(b.column(c).to_pylist() for c in ("tax_id", "at", "text")), strict=True):
                if t != tax_id or not line:
                    done()
                    tax_id, own, line, some = t, [""] * len(heads), list(empty), False
                if at < 0:
                    own = json.loads(cell)
                else:
                    line[at], some = cell, True
                if size > LINES_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                    out.clear()
                    size = 0
        done()
        if len(out) > 1 or (out and out[0] is not first):
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return merged.mapInArrow(run, "value string")


#: Bytes of lines that are handed on at once.
LINES_BYTES = 4_000_000


def write_matrix(cells: DataFrame, labels: DataFrame, value: str, samples: list[str], path: str, totals: DataFrame | None = None) -> None:
    """The wide matrix, in order of its labels, as tab-separated part files with headers."""
    wide_lines(cells, labels, value, sorted(samples), totals).write.mode("overwrite").option("lineSep", "\n").text(path)


def write_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, sep="\t", header=True, nullValue="NA")


def write_json(rows: DataFrame, path: str) -> None:
    """One row as a document with its schema's version."""
    doc = rows.select(F.to_json(F.struct(F.lit("1.2").alias("schema_version"), *rows.columns), {"ignoreNullFields": "false"}))
    doc.coalesce(1).write.mode("overwrite").text(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """Rows as documents, one a line."""
    rows.coalesce(1).write.mode("overwrite").json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").option("lineSep", "\n").text(path)


def write_detection(flags: DataFrame, summary: DataFrame, path: str) -> None:
    """``flagged_samples.tsv``, ``qc_summary.json`` and ``quarantine_list.txt``."""
    numbers = [F.format_string("%.4f", c).alias(c) for c in ("value", "population_median", "deviation")]
    text = flags.select("sample_id", "tax_id", "taxon_name", *numbers, "method").select(*FLAGS)
    text.write.mode("overwrite").csv(f"{path}/flagged_samples.tsv", sep="\t", header=True)
    summary.write.mode("overwrite").json(f"{path}/qc_summary.json")
    flags.select("sample_id").distinct().orderBy("sample_id").write.mode("overwrite").text(f"{path}/quarantine_list.txt")
