"""What the corpus operators share: tables, scratch tables, batches."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles; a longer text is a step of its own.
STEP_BYTES = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch, where the session has Spark's own number, which is ten times as
#: many: whole texts are long, and a batch is held by Spark and by Python at once.
BATCH_ROWS, SPARKS_OWN = 1000, 10_000


def modest_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) == SPARKS_OWN:
        spark.conf.set(name, BATCH_ROWS)


def texts(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """The named columns and ``text``, a null text being an empty one.

    Any other column is left out, so that extra columns can't clash with what
    an operator adds.
    """
    modest_batches(docs.sparkSession)
    return docs.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("text"))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. One of our own only where none is set and all
    of Spark is on this machine; executors elsewhere couldn't read it."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = os.path.join(tempfile.gettempdir(), "tallytree-checkpoints")
        spark.conf.set("spark.checkpoint.dir", at)
    return at


#: Spark's setting by which a write's shuffle files go when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: it survives lost
    executors and no later step computes it twice. What was shuffled for it goes."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    again = spark.read.schema(df.schema).parquet(path)
    again.scratch_path = path
    return again


def discard(*scratch: DataFrame) -> None:
    """Deletes what ``written`` wrote, once nothing still to run reads it."""
    for df in scratch:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Keys that may be hot at most: each of them has more than one row in so many.
HOT_KEYS = 10_000


def parted(keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``keys`` (``times``: rows of the key) without their times: those with more than
    one row in ``HOT_KEYS`` of all, which are that many at most and are broadcast, and
    the others, whose rows may be shuffled."""
    hot = F.col("times") > max(1, (keys.agg(F.sum("times")).first()[0] or 0) // HOT_KEYS)
    return F.broadcast(keys.where(hot).drop("times")), keys.where(~hot).drop("times")


def matched(rows: DataFrame, keys: DataFrame, on: list[str], how: str = "left_semi") -> DataFrame:
    """``rows`` joined with ``keys`` (``on``, ``times``), both written, so that no key's
    rows meet in one task. ``how`` is "left_semi" or "inner"; ``times`` goes."""
    few, rest = parted(keys)
    return rows.join(few, on, how).unionByName(rows.join(few.select(*on), on, "left_anti").join(rest, on, how))


def kept(rows: DataFrame, keys: DataFrame, on: str, *spread: str) -> DataFrame:
    """``matched`` on one long key where ``rows`` are computed and to be gone through once:
    rows of hot keys are dealt by a hash of ``spread`` instead."""
    few, rest = parted(keys)
    told = rows.join(few.select(F.col(on).alias("_few")), F.col(on) == F.col("_few"), "left")
    told = told.withColumn("_by", F.when(F.col("_few").isNotNull(), F.xxhash64(*spread)).otherwise(F.col(on)))
    met = told.join(rest.select(F.col(on).alias("_rest")), F.col("_by") == F.col("_rest"), "left")
    return met.where("_few IS NOT NULL OR _rest IS NOT NULL").select(*rows.columns)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches of fewer rows, so that what Python makes of one stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


_held: dict[tuple, Any] = {}


def held(make: Callable[..., Any], *of: Any) -> Any:
    """``make(*of)``, which a worker keeps filled for its next task. It keeps one
    such table at a time: another one takes its place."""
    if (make, of) not in _held:
        forget()
        _held[make, of] = make(*of)
    return _held[make, of]


def forget() -> None:
    _held.clear()


def give_back() -> None:
    """Returns to the system what the worker has freed, which the allocators would keep."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Run, keeps: bool = False) -> Run:
    """``run`` as a step of many on the same workers, which outlive their tasks: it
    starts without a table of another step (unless it ``keeps`` one itself) and ends
    without memory that it no longer uses."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """A string or binary column in runs of rows of about ``most`` bytes:
    first row, row after the last, the run's bytes, its offsets from 0 on."""
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        to = min(to, len(column))
        yield at, to, raw[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit integers (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
