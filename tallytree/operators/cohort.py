"""Statistics of a whole cohort over one fact table: sample_id, tax_id, domain,
raw, cpm, abs (null where not known)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.robust import histograms, upper_median
from ..schema import HUMAN

#: Prevalence from which a label is core, or accessory.
CORE, ACCESSORY, LEAST_READS = 0.5, 0.1, 5


def sample_stats(fact: DataFrame) -> DataFrame:
    """Per sample: classified and human reads, the rest and its share, summed
    abs of the rest (null only if all of it is), richness, Shannon, Gini-Simpson."""
    v, other = F.col("raw").cast("double"), F.col("tax_id") != HUMAN
    positive = F.when(v > 0, v)
    s = fact.groupBy("sample_id").agg(
        F.sum("raw").alias("classified"), F.sum(F.when(~other, F.col("raw")).otherwise(0)).alias("human"), F.sum(F.when(other, F.col("abs"))).alias("abs_ppm"),
        F.count_if(v > 0).alias("richness"), F.sum(positive * F.log(positive)).alias("vlnv"), F.sum(positive * positive).alias("squares"), F.sum(positive).alias("total"),
    )
    rest, n = F.greatest(F.col("classified") - F.col("human"), F.lit(0)), F.col("total")
    return s.select(
        "sample_id", "classified", "human", rest.alias("nonhuman"), F.when(F.col("classified") > 0, rest / F.col("classified") * 100).otherwise(0.0).alias("pct_nonhuman"), "abs_ppm", "richness",
        F.when(n > 0, F.log(n) - F.col("vlnv") / n).otherwise(0.0).alias("shannon"), F.when(n > 0, 1 - F.col("squares") / (n * n)).otherwise(0.0).alias("simpson"),
    )


def band(prevalence: Column) -> Column:
    return F.when(prevalence >= CORE, "core").when(prevalence >= ACCESSORY, "accessory").otherwise("rare")


def species(fact: DataFrame, n_samples: int, flags: DataFrame | None = None) -> DataFrame:
    """Per label but the human one: prevalence, burden, positives' quantiles,
    robust variation, and how many samples are flagged for it."""
    p = lambda c: F.when(F.col(c) > 0, F.col(c).cast("double"))
    rows = fact.where(F.col("tax_id") != HUMAN)
    out = rows.groupBy("tax_id").agg(
        (F.count(p("raw")) / n_samples).alias("prevalence"), (F.count_if(F.col("raw") >= LEAST_READS) / n_samples).alias("prevalence_at_min"), F.sum("raw").alias("raw_total"),
        F.sum(p("abs")).alias("burden"), F.count(p("cpm")).alias("positives"), F.percentile(p("cpm"), 0.5).alias("cpm_median"), (F.percentile(p("cpm"), 0.75) - F.percentile(p("cpm"), 0.25)).alias("cpm_iqr"),
        F.percentile(p("cpm"), 0.95).alias("cpm_p95"), F.percentile(p("abs"), 0.5).alias("abs_median"), F.max(p("cpm")).alias("cpm_max"),
    )
    away = rows.where("cpm > 0").join(out.select("tax_id", "cpm_median"), "tax_id").groupBy("tax_id").agg(F.percentile(F.abs(F.col("cpm") - F.col("cpm_median")), 0.5).alias("mad"))
    cv = F.when((F.col("positives") >= 2) & (F.col("cpm_median") > 0), F.col("mad") / F.col("cpm_median"))
    out = out.join(away, "tax_id", "left").withColumn("robust_cv", cv).drop("mad").withColumn("band", band(F.col("prevalence")))
    if flags is None:
        return out.withColumn("flagged_samples", F.lit(0).cast("long"))
    n = flags.where("sample_id <> ''").groupBy("tax_id").agg(F.countDistinct("sample_id").alias("flagged_samples"))
    return out.join(n, "tax_id", "left").withColumn("flagged_samples", F.coalesce("flagged_samples", F.lit(0)))


def species_fields(fact: DataFrame, n_samples: int, labels: DataFrame, flags: DataFrame, abs_flags: DataFrame, bins: int = 12) -> DataFrame:
    """All that a cohort's report says of a label: what ``species`` has, the label's name
    (its number where it has none) and domain, the spread of its burden, the samples that
    either pass flags for it, and a logarithmic histogram of its CPM."""
    rows = species(fact, n_samples, flags)
    positive = F.when(F.col("abs") > 0, F.col("abs").cast("double"))
    burden = fact.where(F.col("tax_id") != HUMAN).groupBy("tax_id").agg((F.percentile(positive, 0.75) - F.percentile(positive, 0.25)).alias("abs_iqr_pos"), F.percentile(positive, 0.95).alias("abs_p95_pos"))
    also = abs_flags.where("sample_id <> ''").groupBy("tax_id").agg(F.countDistinct("sample_id").alias("n_flagged_abs"))
    said = labels.select("tax_id", "name", *(["domain"] if "domain" in labels.columns else [F.lit(None).cast("string").alias("domain")])).dropDuplicates(["tax_id"])
    out = rows.join(burden, "tax_id").join(also, "tax_id", "left").join(said, "tax_id", "left").join(histograms(fact, "tax_id", "cpm", bins), "tax_id", "left")
    return out.select(
        "tax_id", F.coalesce("name", F.col("tax_id").cast("string")).alias("name"), F.coalesce("domain", F.lit("Unannotated")).alias("domain"), "prevalence", "prevalence_at_min", F.col("positives").alias("positives_n"),
        F.lit(LEAST_READS).alias("min_reads_for_prevalence"), F.col("cpm_median").alias("cpm_median_pos"), F.col("cpm_iqr").alias("cpm_iqr_pos"), F.col("cpm_p95").alias("cpm_p95_pos"), F.col("abs_median").alias("abs_median_pos"), "abs_iqr_pos", "abs_p95_pos",
        F.col("raw_total").alias("cohort_raw_total"), F.col("burden").alias("cohort_burden_ppm"), F.col("flagged_samples").alias("n_flagged_primary"), F.coalesce("n_flagged_abs", F.lit(0).cast("long")).alias("n_flagged_abs"), F.col("robust_cv").alias("cv_robust"),
        F.array_join(F.coalesce("counts", F.array_repeat(F.lit(0).cast("long"), bins)), ",").alias("sparkline"),
    )


def ranked(rows: DataFrame, order: list[Column], most: int, *keys: str, name: str = "rank") -> DataFrame:
    """The first ``most`` rows of each key, numbered."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(w)).where(F.col(name) <= most)


def by_burden() -> list[Column]:
    return [F.desc_nulls_last("burden"), F.desc("raw_total"), F.asc("tax_id")]


def top_of_bands(rows: DataFrame, most: int = 10) -> DataFrame:
    return ranked(rows, by_burden(), most, "band")


def top_taxa(fact: DataFrame, most: int = 10) -> DataFrame:
    return ranked(fact.where("raw > 0"), [F.desc("raw"), F.asc("tax_id")], most, "sample_id")


def top_samples(fact: DataFrame, most: int = 10) -> DataFrame:
    return ranked(fact.where("raw > 0"), [F.desc("raw"), F.asc("sample_id")], most, "tax_id")


def rank_abundance(rows: DataFrame, most: int = 200) -> DataFrame:
    """The labels of the highest burdens, numbered: the limit comes first, so
    that only its rows are in one task."""
    top = rows.where("raw_total > 0").orderBy(F.desc("raw_total"), "tax_id").limit(most)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("raw_total"), "tax_id")))


def composition(fact: DataFrame) -> DataFrame:
    """Reads of each sample in each domain, and their share."""
    sums = fact.groupBy("sample_id", F.coalesce("domain", F.lit("Unannotated")).alias("domain")).agg(F.sum("raw").alias("reads"))
    return sums.withColumn("share", F.col("reads") / F.sum("reads").over(Window.partitionBy("sample_id")))


def domain_cpm(fact: DataFrame) -> DataFrame:
    rows = fact.where(F.col("tax_id") != HUMAN)
    return rows.groupBy("sample_id", F.coalesce("domain", F.lit("Unannotated")).alias("domain")).agg(F.sum("cpm").alias("cpm"))


def dominant_domain(fact: DataFrame, informative: tuple[str, ...]) -> DataFrame:
    """The domain with most CPM of each sample, of those that say something."""
    sums = domain_cpm(fact)
    best = sums.where(F.col("domain").isin(*informative) & (F.col("cpm") > 0)).groupBy("sample_id").agg(F.min_by("domain", F.struct(-F.col("cpm"), F.col("domain"))).alias("domain"))
    every = fact.select("sample_id").distinct()
    return every.join(best, "sample_id", "left").withColumn("domain", F.coalesce("domain", F.lit("no informative domain")))


def domain_burden(rows: DataFrame, label_domain: DataFrame) -> DataFrame:
    metric = F.coalesce("burden", F.col("raw_total").cast("double"))
    return rows.join(label_domain, "tax_id", "left").where(metric > 0).groupBy(F.coalesce("domain", F.lit("Unannotated")).alias("domain")).agg(F.sum(metric).alias("burden"))


def top_and_others(fact: DataFrame, names: DataFrame, most: int = 10) -> DataFrame:
    """Reads of the ``most`` largest labels, all others as one."""
    totals = fact.where("raw > 0").groupBy("tax_id").agg(F.sum("raw").alias("reads"))
    first = totals.orderBy(F.desc("reads"), "tax_id").limit(most).join(names.select("tax_id", "name"), "tax_id", "left").select("tax_id", F.coalesce("name", F.lit("")).alias("label"))
    named = totals.join(F.broadcast(first), "tax_id", "left").withColumn("label", F.coalesce("label", F.lit("other species")))
    return named.groupBy("label").agg(F.sum("reads").alias("reads"))


def over_threshold(stats: DataFrame, ppm: float = 1000.0) -> DataFrame:
    return stats.where(F.col("abs_ppm") > ppm)


def every_kth(samples: DataFrame, n: int, cap: int) -> DataFrame:
    """A fixed subsample of at most about ``cap`` samples, in order of their ids."""
    step = -(-n // cap) if n > cap else 1
    rows = samples.select("sample_id").distinct()
    return rows.withColumn("at", F.row_number().over(Window.orderBy("sample_id"))).where((F.col("at") - 1) % step == 0).select("sample_id")


def executive(stats: DataFrame, rows: DataFrame) -> DataFrame:
    """One row: totals, upper medians, and how many labels are in each band."""
    a = stats.agg(F.count("*").alias("samples"), F.sum("classified").alias("classified"), F.sum("nonhuman").alias("nonhuman"), upper_median("pct_nonhuman").alias("median_pct_nonhuman"))
    b = rows.agg(*(F.count_if(F.col("band") == x).alias(x) for x in ("core", "accessory", "rare")), F.min_by("tax_id", F.struct(-F.coalesce("burden", F.lit(-1.0)), -F.col("raw_total"), F.col("tax_id"))).alias("top_by_burden"))
    return a.join(F.broadcast(b))
