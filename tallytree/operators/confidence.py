"""Per-read confidence from k-mer hits, and tiers of reads that pass thresholds."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import small
from ..schema import checked_threshold, tier_suffix
from .aggregate import of_ranks
from .taxonomy import roll_up


def cut(kmers: Column) -> Column:
    """The tokens of a k-mer string. All white space is made a blank first: cutting at a blank needs no pattern."""
    return F.split(F.translate(kmers, "\t\n\x0b\f\r", " " * 5), " ")


def number(text: Column) -> Column:
    """``text`` as a long, null if it isn't one. What begins or ends with a letter isn't tried: a
    cast that fails costs as much as hundreds that don't."""
    tried = (text != "") & (F.substring(text, 1, 1) <= "9") & (F.substring(text, -1, 1) <= "9")
    return F.when(tried, text.try_cast("long"))


def count_of(token: Column) -> Column:
    """What follows a token's last colon, if that is a number; null in malformed tokens."""
    return F.when(F.contains(token, F.lit(":")), number(F.substring_index(token, ":", -1)))


def label_of(token: Column) -> Column:
    """What comes before a token's last colon."""
    return F.substring(token, F.lit(1), F.length(token) - F.length(F.substring_index(token, ":", -1)) - 1)


def tokens(reads: DataFrame, kmers: str = "kmers") -> DataFrame:
    """``label`` and ``n`` of each k-mer token, beside the other columns. The
    count follows the last colon; pair marks, malformed tokens and counts under 1 go."""
    rest = [c for c in reads.columns if c != kmers]
    each = reads.select(*rest, F.explode(cut(F.col(kmers))).alias("t")).where("t <> '|:|'")
    return each.select(*rest, "t", count_of(F.col("t")).alias("n")).where("n > 0").select(*rest, label_of(F.col("t")).alias("label"), "n")


#: What Spark trims before it casts, and what it then takes for a long.
TRIMMED, WHOLE = "".join(map(chr, (*range(0x21), 0x7F))), re.compile("[+-]?[0-9]+")


def numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What ``number`` gives, for a batch: the values (0 without one), and where there is one.
    Signs, control characters and long rows of digits are rare and are looked at one by one."""
    plain = pc.match_substring_regex(texts, "^[0-9]{1,18}$")
    value = pc.if_else(plain, texts, "0").cast(pa.int64()).to_numpy(zero_copy_only=False).copy()
    known = plain.to_numpy(zero_copy_only=False).copy()
    odd = pc.and_not(pc.match_substring_regex(texts, r"^[\x00-\x20+\-0-9]"), plain)
    for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
        text = texts[int(i)].as_py()
        digits = text.strip(TRIMMED)
        if text[-1] <= "9" and WHOLE.fullmatch(digits) and -(1 << 63) <= int(digits) < 1 << 63:
            value[i], known[i] = int(digits), True
    return value, known


def sums_of_tokens(kmers: pa.Array, tax_id: pa.Array) -> pa.Array:
    """``inside`` and ``total`` of each string of k-mers; 0 of a null one."""
    cut_ = pc.ascii_split_whitespace(kmers)
    size = pc.fill_null(pc.list_value_length(cut_), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    read = np.repeat(np.arange(len(kmers)), size)
    parts = pc.extract_regex(cut_.flatten(), "(?s)^(?P<label>.*):(?P<n>[^:]*)$")
    label, end = (pc.fill_null(pc.struct_field(parts, f), "") for f in ("label", "n"))
    n, known = numbers(end)
    n[~known | (n < 0) | pc.equal(label, "A").to_numpy(zero_copy_only=False)] = 0
    own, is_number = numbers(label)
    mine = is_number & (own == pc.fill_null(tax_id, 0).to_numpy(zero_copy_only=False)[read])
    upto = np.append(0, np.cumsum(size))

    def summed(x: np.ndarray) -> pa.Array:
        each = np.append(0, np.cumsum(x))
        return pa.array(each[upto[1:]] - each[upto[:-1]])

    return pa.StructArray.from_arrays([summed(np.where(mine, n, 0)), summed(n)], names=["inside", "total"])


def own_sums(reads: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``tax_id``, and of each row's k-mers, but for ambiguous ones, those of its
    own label and all: summed within the row. An unassigned read's aren't parsed."""
    sums = F.arrow_udf(sums_of_tokens, "inside long, total long")
    assigned = F.when(F.col("tax_id") > 0, F.col("kmers"))
    each = reads.select(*keys, "tax_id", sums(assigned, F.col("tax_id")).alias("s"))
    return each.select(*keys, "tax_id", F.lit(1).cast("long").alias("lines"), "s.inside", "s.total")


def kmer_sums(reads: DataFrame, lineage: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``tax_id``, ``lines`` (rows of ``reads``), ``inside`` (k-mers of the label or
    one of its descendants), ``total`` (all but ambiguous ones). Only reads whose label has
    others below it look their tokens up in the tree; of all others a row of numbers is
    shuffled, and k-mer strings never are."""
    keys = tuple(k for k in keys if k != "tax_id")
    below = lineage.where("tax_id <> ancestor_id").select(F.col("tax_id").alias("label_id"), F.col("ancestor_id").alias("tax_id"))
    inner = reads.select(*keys, "tax_id", "kmers").where("tax_id > 0").join(small(below.select("tax_id").distinct()), "tax_id", "left_semi")
    hits = tokens(inner).where("label <> 'A'").withColumn("label_id", number(F.col("label")))
    zero = F.lit(0).cast("long")
    deeper = hits.join(below, ["tax_id", "label_id"]).select(*keys, "tax_id", zero.alias("lines"), F.col("n").alias("inside"), zero.alias("total"))
    # dealt first: almost every read is one row, so that there is nothing to combine before
    rows = own_sums(reads, *keys).unionByName(deeper).repartition(*keys, "tax_id")
    return rows.groupBy(*keys, "tax_id").agg(*(F.sum(c).alias(c) for c in ("lines", "inside", "total")))


def share() -> Column:
    """The confidence of ``kmer_sums``' rows: 0 for an unassigned read and for one without k-mers that count."""
    ratio = F.when((F.col("tax_id") > 0) & (F.col("total") > 0), F.col("inside") / F.col("total")).otherwise(0.0)
    return F.coalesce(ratio, F.lit(0.0)).alias("confidence")


def read_confidence(reads: DataFrame, lineage: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``tax_id``, ``confidence``: the share of a read's k-mers, but
    for ambiguous ones ("A"), whose label is its own or one of its descendants.
    0 for an unassigned read and for one without such k-mers."""
    each = kmer_sums(reads, lineage, *keys)
    return each.select("*", F.explode(F.array_repeat(F.lit(0), F.col("lines").cast("int"))).alias("line")).select(*keys, "tax_id", share())


def tiers(confident: DataFrame, thresholds: list[float]) -> DataFrame:
    """``tier``, ``sample_id``, ``tax_id``, ``direct_reads``: reads under a tier's
    threshold count as unclassified. One pass serves all thresholds; 0 is no tier."""
    kept = sorted({checked_threshold(t) for t in thresholds} - {0.0})
    each = confident.withColumn("t", F.explode(F.array(*map(F.lit, kept))))
    label = F.when(F.col("confidence") >= F.col("t"), F.greatest(F.col("tax_id"), F.lit(0))).otherwise(0)
    names = F.create_map(*(F.lit(x) for t in kept for x in (t, tier_suffix(t))))
    return each.groupBy(names[F.col("t")].alias("tier"), "sample_id", label.alias("tax_id")).agg(F.count("*").alias("direct_reads"))


def tier_counters(confident: DataFrame, threshold: float) -> DataFrame:
    """Per sample: all reads, those unclassified from the start, those demoted, those left."""
    low = (F.col("tax_id") > 0) & (F.col("confidence") < threshold)
    return confident.groupBy("sample_id").agg(
        F.count("*").alias("total_reads"), F.count_if(F.col("tax_id") <= 0).alias("originally_unclassified"),
        F.count_if(low).alias("demoted_to_unclassified"), F.count_if((F.col("tax_id") > 0) & (F.col("confidence") >= threshold)).alias("classified_after_filter"),
    )


def demoted(confident: DataFrame, thresholds: list[float]) -> DataFrame:
    """``tier``, ``sample_id``, ``demoted``: reads that a tier takes for unclassified."""
    kept = sorted({checked_threshold(t) for t in thresholds} - {0.0})
    sums = [F.count_if((F.col("tax_id") > 0) & (F.col("confidence") < t)).alias(tier_suffix(t)) for t in kept]
    return confident.groupBy("sample_id").agg(*sums).unpivot("sample_id", [tier_suffix(t) for t in kept], "tier", "demoted")


def last_outputs(rows: DataFrame) -> DataFrame:
    """Of samples with several per-read outputs, the lines of the one whose path sorts last."""
    last = rows.groupBy("sample_id").agg(F.max("source_path").alias("source_path"))
    return rows.join(last, ["sample_id", "source_path"], "left_semi")


def tier_samples(samples: DataFrame, direct: DataFrame, tiers_: list[str]) -> DataFrame:
    """``tier``, ``sample_id``, ``direct_total`` of every sample (sample_id,
    direct_total) in every tier: of a sample without output the sensitive tier's
    total, and no cells; it stays in all means and medians as zeros."""
    own = direct.groupBy("tier", "sample_id").agg(F.sum("direct_reads").alias("own"))
    every = samples.select("sample_id", "direct_total", F.explode(F.array(*map(F.lit, tiers_))).alias("tier"))
    return every.join(own, ["tier", "sample_id"], "left").select("tier", "sample_id", F.coalesce("own", "direct_total").alias("direct_total"), F.col("own").isNotNull().alias("has_output"))


def tier_cells(direct: DataFrame, samples: DataFrame, lineage: DataFrame, label: DataFrame, ranks: list[str] | tuple[str, ...], min_reads: int = 0, read_totals: DataFrame | None = None) -> DataFrame:
    """``tier``, ``rank_scope``, ``sample_id``, ``tax_id``, ``raw``, ``cpm``, ``abs``: the
    matrices of each tier, of all labels and of each rank. Ranks but species take
    clade counts. ``samples`` is what ``tier_samples`` gives."""
    totals = samples.select("tier", "sample_id", "direct_total")
    named = lambda rows, column: rows.where(F.col(column) >= min_reads).select("tier", "sample_id", "tax_id", F.col(column).alias("raw"))
    # counts go up to labels of the wanted ranks alone; one without any counts for itself and has no such rank
    upper = label.where(F.col("rank").isin([r for r in ranks if r != "S"])).select(F.col("tax_id").alias("ancestor_id")).distinct()
    lineage = lineage.join(small(upper), "ancestor_id", "left_semi")
    every, clades = named(direct, "direct_reads"), named(roll_up(direct, lineage, "tier", "sample_id"), "clade_reads")
    scoped = every.withColumn("rank_scope", F.lit("all")).unionByName(of_ranks(clades, label, [r for r in ranks if r != "S"])).unionByName(of_ranks(every, label, [r for r in ranks if r == "S"]))
    out = scoped.join(small(totals), ["tier", "sample_id"]).withColumn("cpm", F.when(F.col("direct_total") > 0, F.col("raw") / F.col("direct_total") * 1e6).otherwise(0.0))
    if read_totals is None:
        out = out.withColumn("abs", F.lit(None).cast("double"))
    else:
        known = read_totals.select("sample_id", F.when(F.col("total_reads") > 0, F.col("total_reads")).alias("all_reads"))
        out = out.join(known, "sample_id", "left").withColumn("abs", F.col("raw") / F.col("all_reads") * 1e6)
    return out.select("tier", "rank_scope", "sample_id", "tax_id", "raw", "cpm", "abs")


def tier_records(direct: DataFrame, lineage: DataFrame) -> DataFrame:
    """Report rows of each tier and sample: direct and clade reads, and the
    clade's percentage of all reads, the unclassified ones included."""
    clades = roll_up(direct, lineage, "tier", "sample_id")
    total = direct.groupBy("tier", "sample_id").agg(F.sum("direct_reads").alias("total"))
    rows = clades.join(direct, ["tier", "sample_id", "tax_id"], "left").join(total, ["tier", "sample_id"])
    return rows.select("tier", "sample_id", "tax_id", F.coalesce("direct_reads", F.lit(0)).alias("direct_reads"), "clade_reads", (F.col("clade_reads") / F.col("total") * 100).alias("percentage"))


def without_reads(samples: DataFrame, direct: DataFrame, tiers_: list[str]) -> DataFrame:
    """For outputs (sample_id) that hold no read: one unclassified row a tier, of 0 reads."""
    empty = samples.select("sample_id").distinct().join(direct.select("sample_id").distinct(), "sample_id", "left_anti")
    zero = F.lit(0).cast("long")
    return empty.select(F.explode(F.array(*map(F.lit, tiers_))).alias("tier"), "sample_id", zero.alias("tax_id"), zero.alias("direct_reads"), zero.alias("clade_reads"), F.lit(0.0).alias("percentage"))
