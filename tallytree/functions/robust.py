"""Exact order statistics of cells of which most are zeros that aren't stored.

A group's stored values come with one more row that stands for all its zeros:
``value`` and ``weight`` (how many). Nothing is made dense.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_zeros(cells: DataFrame, n_samples: int, *keys: str) -> DataFrame:
    """``keys``, ``sample_id``, ``value``, ``weight``: the stored cells and, for
    samples that have none, one weighted zero (its sample_id is null)."""
    stored = cells.select(*keys, "sample_id", F.col("value").cast("double").alias("value"), F.lit(1).cast("long").alias("weight"))
    zeros = cells.groupBy(*keys).agg((F.lit(n_samples) - F.count("*")).cast("long").alias("weight")).where("weight > 0")
    return stored.unionByName(zeros.select(*keys, F.lit(None).cast("string").alias("sample_id"), F.lit(0.0).alias("value"), "weight"))


def weighted_median(value: str, weight: str = "weight") -> Column:
    """The mean of the middle two."""
    return F.expr(f"percentile({value}, 0.5D, {weight})")


def upper_median(value: str) -> Column:
    """Of an even number of values the higher middle one; no list of them is made."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value} DESC)")


def quartiles(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``q1``, ``q3``: medians of the lower and upper half, the middle
    value of an odd number left out (of one value, itself)."""
    order = Window.partitionBy(*keys).orderBy("value")
    upto = rows.withColumn("upto", F.sum("weight").over(order.rangeBetween(Window.unboundedPreceding, 0)))
    sized = upto.join(rows.groupBy(*keys).agg(F.sum("weight").alias("n")), list(keys))
    half = F.greatest(F.expr("n div 2"), F.lit(1))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("value")))
    low, high = F.expr("(greatest(n div 2, 1) - 1) div 2"), F.expr("greatest(n div 2, 1) div 2")
    upper = F.col("n") - half
    got = sized.groupBy(*keys).agg(at(low).alias("a"), at(high).alias("b"), at(upper + low).alias("c"), at(upper + high).alias("d"), F.first("n").alias("n"))
    return got.select(*keys, ((F.col("a") + F.when(F.expr("n div 2") % 2 == 0, F.col("b")).otherwise(F.col("a"))) / 2).alias("q1"), ((F.col("c") + F.when(F.expr("n div 2") % 2 == 0, F.col("d")).otherwise(F.col("c"))) / 2).alias("q3"))


def histogram(rows: DataFrame, value: str, bins: int, log: bool = False) -> DataFrame:
    """``bin`` (0 to bins - 1), ``n``: equal widths from the least to the greatest
    value, which falls in the last bin; with ``log``, of log10 of what is over 0.
    Bins without values are there with 0."""
    x = rows.select(F.col(value).cast("double").alias("x")).where("x IS NOT NULL AND NOT isnan(x)")
    x = x.where("x > 0").select(F.log10("x").alias("x")) if log else x
    ends = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).withColumn("hi", F.when(F.col("hi") <= F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi")))
    placed = x.join(F.broadcast(ends)).select(F.least(F.floor((F.col("x") - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1)).cast("int").alias("bin"))
    every = rows.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(placed.groupBy("bin").agg(F.count("*").alias("n")), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def histograms(rows: DataFrame, key: str, value: str, bins: int) -> DataFrame:
    """``key`` and ``counts``: how many of the key's values over 0 are in each of ``bins`` of
    equal width on a logarithmic scale, from its least to its greatest value."""
    x = rows.where(F.col(value) > 0).select(key, F.log10(F.col(value).cast("double")).alias("x"))
    whole = Window.partitionBy(key)
    ends = x.withColumn("lo", F.min("x").over(whole)).withColumn("hi", F.max("x").over(whole))
    width = F.when(F.col("hi") <= F.col("lo"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")) / bins
    placed = ends.select(key, F.least(F.floor((F.col("x") - F.col("lo")) / width), F.lit(bins - 1)).cast("int").alias("bin"))
    counted = placed.groupBy(key, "bin").agg(F.count("*").alias("n")).groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    return counted.select(key, F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda b: F.coalesce(F.col("m")[b], F.lit(0).cast("long"))).alias("counts"))


def summary(value: str) -> list[Column]:
    """n, least, 5, 25, 50, 75, 95 % and greatest of what is neither null nor NaN."""
    x = F.when(~F.isnan(F.col(value).cast("double")), F.col(value).cast("double"))
    cuts = [(0.05, "q05"), (0.25, "q25"), (0.5, "median"), (0.75, "q75"), (0.95, "q95")]
    return [F.count(x).alias("n"), F.min(x).alias("min"), *(F.percentile(x, q).alias(name) for q, name in cuts), F.max(x).alias("max")]
