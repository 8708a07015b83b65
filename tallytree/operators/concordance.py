"""How flags of different passes agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def agreement(one: DataFrame, other: DataFrame, key: str = "sample_id") -> DataFrame:
    """Each key flagged by either pass, and by which."""
    a = one.select(key).distinct().withColumn("in_one", F.lit(True))
    b = other.select(key).distinct().withColumn("in_other", F.lit(True))
    both = a.join(b, key, "full")
    return both.select(key, F.when(F.col("in_one") & F.col("in_other"), "both").when(F.col("in_one"), "first only").otherwise("second only").alias("found_in"))


def flags_per_label(flags: DataFrame, most: int = 5) -> DataFrame:
    """Rows, not distinct samples: a sample that three methods flag counts three times."""
    return flags.groupBy("taxon_name").agg(F.count("*").alias("flags")).orderBy(F.desc("flags"), "taxon_name").limit(most)
