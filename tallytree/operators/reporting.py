"""What a report says of a cohort: lists, plots' points, agreement of tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.robust import histogram, upper_median
from ..schema import HUMAN, ROOT, UNCLASSIFIED
from .cohort import by_burden, domain_cpm, ranked
from .concordance import agreement

#: The order of domains in a legend; others follow by name.
LEGEND = ("Bacteria", "Viruses", "Fungi", "Archaea", "Metazoa_other", "Viridiplantae", "Unannotated", "Other")


def informative(rows: DataFrame) -> DataFrame:
    """Without the unclassified and the root, which would outweigh all else in distances."""
    return rows.where(~F.col("tax_id").isin(UNCLASSIFIED, ROOT))


def leading(species: DataFrame, most: int = 50) -> DataFrame:
    """The ``most`` informative labels of the highest burdens, as they are drawn."""
    return informative(species).orderBy(*by_burden()).limit(most)


def quadrants(species: DataFrame, absolute: bool = True) -> DataFrame:
    """``tax_id``, ``prevalence``, ``level`` (the positives' median of abs, or of
    CPM) and ``quadrant``: cut at half of the samples and at the levels' upper median."""
    level = F.col("abs_median" if absolute else "cpm_median")
    points = species.select("tax_id", "prevalence", level.alias("level")).where("level > 0 AND prevalence > 0")
    middle = points.agg(upper_median("level").alias("middle"))
    often, much = F.col("prevalence") >= 0.5, F.col("level") >= F.col("middle")
    name = F.when(often & much, "systemic burden").when(often, "core kitome").when(much, "outburst").otherwise("trace")
    return points.join(F.broadcast(middle)).select("tax_id", "prevalence", "level", name.alias("quadrant"))


def scatter(species: DataFrame, most: int = 200) -> DataFrame:
    """Prevalence against the positives' median CPM of the first labels by burden."""
    return species.orderBy(*by_burden()).limit(most).where("cpm_median > 0").select("tax_id", "prevalence", "cpm_median", F.coalesce("cpm_p95", "cpm_median").alias("cpm_p95"))


def burden_by_domain(fact: DataFrame) -> DataFrame:
    """How the samples' summed CPM of each domain are spread."""
    sums = domain_cpm(fact.where("cpm > 0"))
    cuts = [(0.05, "q05"), (0.25, "q25"), (0.5, "median"), (0.75, "q75"), (0.95, "q95")]
    return sums.groupBy("domain").agg(F.count("*").alias("samples"), *(F.percentile("cpm", q).alias(n) for q, n in cuts))


def diversity(stats: DataFrame, bins: int = 20) -> DataFrame:
    """``measure``, ``bin``, ``n``: histograms of Shannon's index and of richness."""
    both = [histogram(stats, m, bins).select(F.lit(m).alias("measure"), "bin", "n") for m in ("shannon", "richness")]
    return both[0].unionByName(both[1])


def notable(stats: DataFrame, flagged: DataFrame, most: int = 15) -> DataFrame:
    """``list``, ``rank``, ``sample_id``: the first samples by burden, by share of
    non-human reads, by Shannon's index, and of those flagged by any pass the
    first by burden. Ties go by sample."""
    lists = {"burden": (stats.where("abs_ppm IS NOT NULL"), "abs_ppm"), "composition": (stats, "pct_nonhuman"), "diversity": (stats, "shannon"), "flagged": (stats.join(flagged.select("sample_id").distinct(), "sample_id", "left_semi"), "abs_ppm")}
    out = None
    for name, (rows, by) in lists.items():
        # the limit comes first: only its rows are numbered in one task
        first = rows.select("sample_id", F.coalesce(F.col(by), F.lit(0.0)).alias("by")).orderBy(F.desc("by"), "sample_id").limit(most)
        part = ranked(first.withColumn("list", F.lit(name)), [F.desc("by"), F.asc("sample_id")], most, "list").select("list", "rank", "sample_id")
        out = part if out is None else out.unionByName(part)
    return out


def means(fact: DataFrame, n_samples: int, most: int = 10) -> DataFrame:
    """The labels of most reads: their reads, and CPM and abs over all samples,
    those without the label included."""
    sums = fact.groupBy("tax_id").agg(F.sum("raw").alias("raw_total"), (F.sum(F.coalesce("cpm", F.lit(0.0))) / n_samples).alias("mean_cpm"), (F.sum(F.coalesce("abs", F.lit(0.0))) / n_samples).alias("mean_abs"))
    return sums.where("raw_total > 0").orderBy(F.desc("raw_total"), "tax_id").limit(most)


def legend(domains: DataFrame) -> DataFrame:
    """``domain``, ``place``: the order in which domains are drawn."""
    seen = domains.where("domain <> ''").select("domain").distinct()
    at = F.array_position(F.array(*map(F.lit, LEGEND)), F.col("domain"))
    order = Window.orderBy(F.when(at > 0, at).otherwise(len(LEGEND) + 1), "domain")  # as many rows as there are domains
    return seen.withColumn("place", F.row_number().over(order))


def only_flagged(rows: DataFrame, flagged: DataFrame) -> DataFrame:
    return rows.join(flagged.select("sample_id").distinct(), "sample_id", "left_semi")


def flag_agreement(sensitive: DataFrame, tiers: DataFrame) -> DataFrame:
    """``tier``, ``flagged``, ``shared``, ``sensitive_only``, ``tier_only``: how the
    samples flagged in each tier (tier, sample_id) agree with the sensitive ones."""
    base = sensitive.select("sample_id").distinct()
    each = tiers.select("tier", "sample_id").distinct()
    met = each.join(base.withColumn("there", F.lit(True)), "sample_id", "left")
    counts = met.groupBy("tier").agg(F.count("*").alias("flagged"), F.count("there").alias("shared"))
    return counts.join(F.broadcast(base.agg(F.count("*").alias("all")))).select("tier", "flagged", "shared", (F.col("all") - F.col("shared")).alias("sensitive_only"), (F.col("flagged") - F.col("shared")).alias("tier_only"))


def discussion(species: DataFrame, names: DataFrame, most: int = 3) -> DataFrame:
    """``band``, ``rank``, ``name``: the first core labels, and the first rare ones with a burden."""
    told = species.where((F.col("band") == "core") | ((F.col("band") == "rare") & (F.col("burden") > 0)))
    first = ranked(told, by_burden(), most, "band")
    return first.join(names.select("tax_id", "name"), "tax_id", "left").select("band", "rank", F.coalesce("name", F.lit("")).alias("name"))


def provenance(samples: DataFrame, summaries: DataFrame) -> DataFrame:
    """Each sample with what its read-total document says; null where there is none."""
    said = summaries.select("sample_id", *(c for c in ("total_reads", "total_mapped", "total_unmapped", "input", "extraction_time") if c in summaries.columns))
    return samples.join(said, "sample_id", "left")


def extraction(expected: DataFrame, files: DataFrame, summaries: DataFrame) -> DataFrame:
    """A row for each expected sample: ``sample_id``, ``input``, ``status`` (OK where it has
    files of reads), ``read_count`` (over its files: sample_id, source_path, reads), the totals
    of its document, and ``output_files``, in order."""
    done = files.groupBy("sample_id").agg(F.sum("reads").alias("read_count"), F.array_join(F.sort_array(F.collect_set("source_path")), ";").alias("output_files"))
    told = provenance(batch(expected, done.select("sample_id", "read_count", F.lit(None).cast("long").alias("total_reads"))).drop("total_reads"), summaries)
    return told.join(done.select("sample_id", "output_files"), "sample_id", "left").select("sample_id", "input", "status", "read_count", "total_mapped", "total_unmapped", "total_reads", F.coalesce("output_files", F.lit("")).alias("output_files"))


def drill_down(fact: DataFrame, species: DataFrame, labels: int = 25, samples: int = 10) -> DataFrame:
    """``place`` (by burden), ``tax_id``, ``rank``, ``sample_id``, ``raw``, ``cpm``, ``abs``: the
    samples that have most of each of the first informative labels."""
    first = ranked(leading(species, labels).withColumn("all", F.lit(1)), by_burden(), labels, "all", name="place").select("place", "tax_id")
    cells = fact.join(F.broadcast(first), "tax_id").where("raw > 0")
    return ranked(cells, [F.desc("raw"), F.asc("sample_id")], samples, "tax_id").select("place", "tax_id", "rank", "sample_id", "raw", "cpm", "abs")


def burden_histogram(stats: DataFrame, bins: int = 30) -> DataFrame:
    """``bin``, ``n``: samples by the logarithm of their burden, where it is over 0."""
    return histogram(stats, "abs_ppm", bins, log=True)


def detection_overview(flags: DataFrame, abs_flags: DataFrame | None) -> DataFrame:
    """``what``, ``n``: flags and flagged samples of each method, and samples that the primary
    and the abs pass flag both, or one of them alone."""
    by = flags.groupBy("method").agg(F.count("*").alias("flags"), F.countDistinct("sample_id").alias("samples"))
    out = by.select(F.explode(F.array(F.struct(F.concat(F.lit("flags, "), "method").alias("what"), F.col("flags").alias("n")), F.struct(F.concat(F.lit("samples, "), "method").alias("what"), F.col("samples").alias("n")))).alias("x")).select("x.*")
    if abs_flags is None:
        return out
    names = {"both": "samples, both passes", "first only": "samples, primary pass alone", "second only": "samples, abs pass alone"}
    told = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return out.unionByName(agreement(flags, abs_flags).groupBy(told[F.col("found_in")].alias("what")).agg(F.count("*").alias("n")))


def domain_mix(fact: DataFrame) -> DataFrame:
    """``domain``, ``reads``, ``share`` of all samples' reads but the host's."""
    rows = fact.where(F.col("tax_id") != HUMAN).groupBy(F.coalesce("domain", F.lit("Unannotated")).alias("domain")).agg(F.sum("raw").alias("reads"))
    return rows.join(F.broadcast(rows.agg(F.sum("reads").alias("all")))).select("domain", "reads", (F.col("reads") / F.nullif("all", F.lit(0))).alias("share"))


def pipeline_summary(metadata: DataFrame, summary: DataFrame, flagged: DataFrame) -> DataFrame:
    """One row: samples and labels of the cohort (sample_count, taxon_count), the method
    and the flags of the primary pass (method, flagged_count; counted where it says
    none), and how many samples are in quarantine."""
    counted = flagged.agg(F.count("*").alias("rows"), F.countDistinct("sample_id").alias("quarantined_samples"))
    both = metadata.join(F.broadcast(summary.select("method", "flagged_count"))).join(F.broadcast(counted))
    return both.select(F.col("sample_count").alias("samples"), F.col("taxon_count").alias("taxa_in_matrix"), F.col("method").alias("detection_method"), F.coalesce("flagged_count", "rows").alias("flagged_pairs"), "quarantined_samples")


def batch(expected: DataFrame, done: DataFrame) -> DataFrame:
    """``sample_id``, ``status`` and the read counts of each expected sample: OK
    where there is a result, else FAILED and 0."""
    counts: list[Column] = [F.coalesce("read_count", F.lit(0)).cast("long").alias("read_count"), "total_reads"]
    return expected.select("sample_id").distinct().join(done.select("sample_id", "read_count", "total_reads", F.lit("OK").alias("ok")), "sample_id", "left").select("sample_id", F.coalesce("ok", F.lit("FAILED")).alias("status"), *counts)
