"""Tables that one step of a loop leaves for the next."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side of a join is broadcast (a few numbers and names each); beyond it both are shuffled.
BROADCAST_ROWS = 400_000


def folder(spark: SparkSession) -> str:
    """The folder that all executors share, ``spark.checkpoint.dir``; where none is set, and
    Spark is all on this machine, one of our own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(tempfile.gettempdir(), "tallytree-tables")


def kept(rows: DataFrame) -> DataFrame:
    """``rows`` written to the shared folder and read again, so that plans don't grow from
    step to step and lost executors cost one step."""
    spark = rows.sparkSession
    path = f"{folder(spark)}/{uuid.uuid4().hex}"
    rows.write.parquet(path)
    again = spark.read.schema(rows.schema).parquet(path)
    again.kept_at = path
    return again


def dropped(*tables: DataFrame) -> None:
    """Deletes what ``kept`` wrote, once nothing still to run reads it."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.kept_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcasting if it has few rows, so that the other side isn't shuffled."""
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows
