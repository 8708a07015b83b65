"""A cohort report: bounded tables of the cohort's statistics as HTML, and a manifest."""

from __future__ import annotations

import json
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators import cohort, ordination, reporting

#: Rows shown of each table.
SHOWN = {"species": 200, "samples": 200, "bands": 10, "notable": 15, "flags": 200, "leading": 50, "clustered": 500, "ordinated": 2000, "cells": 25_000}


def cell(value: object) -> str:
    if value is None:
        return "NA"
    return f"{value:,.4g}" if isinstance(value, float) else escape(f"{value:,}" if isinstance(value, int) else str(value))


def section(number: str, title: str, rows: DataFrame, most: int) -> str:
    """A section with the first ``most`` rows of a table that is already in order."""
    got = rows.limit(most).toArrow()
    head = "".join(f"<th>{escape(c)}</th>" for c in got.column_names)
    body = "".join("<tr>" + "".join(f"<td>{cell(v)}</td>" for v in r.values()) + "</tr>" for r in got.to_pylist())
    return f'<section id="s{number}"><h2>{number} {escape(title)}</h2><table><tr>{head}</tr>{body}</table></section>'


def ordered(fact: DataFrame, species: DataFrame, n_samples: int, cluster: str) -> list[tuple[str, str, DataFrame, int]]:
    """The sections that stand on distances: both heat maps in the order of the labels' and
    the samples' trees, and principal coordinates of three samples or more. Samples are
    every k-th where there are more than the caps."""
    top = reporting.leading(species, SHOWN["leading"]).select("tax_id")
    cells = reporting.informative(fact).select("sample_id", "tax_id", F.col("cpm").alias("value"), "abs")
    chosen = cohort.every_kth(cells, n_samples, SHOWN["clustered"])
    drawn = cells.join(F.broadcast(top), "tax_id", "left_semi").join(chosen, "sample_id", "left_semi")
    distance = F.col("bray_curtis").alias("distance")
    turned = drawn.select(F.col("tax_id").alias("sample_id"), F.col("sample_id").alias("tax_id"), "value")
    _, down = ordination.linkage(drawn.select(F.col("tax_id").alias("item")).distinct(), ordination.pairwise(turned).select("a", "b", distance), cluster)
    _, across = ordination.linkage(drawn.select(F.col("sample_id").alias("item")).distinct(), ordination.pairwise(drawn).select("a", "b", distance), cluster)
    maps = [("3.6.1", "Heat map of CPM", drawn), ("3.6.5", "Heat map of burden", drawn.select("sample_id", "tax_id", F.col("abs").alias("value")))]
    out = [(number, title, ordination.heat_map(rows.where("value > 0"), down, across).orderBy("row", "column"), SHOWN["cells"]) for number, title, rows in maps]
    points = cohort.every_kth(cells, n_samples, SHOWN["ordinated"]).select(F.col("sample_id").alias("item"))
    near = ordination.pairwise(cells.join(points, F.col("sample_id") == F.col("item"), "left_semi")).select("a", "b", distance)
    found, shares = ordination.coordinates(points, near)
    title = f"Principal coordinates ({shares[0]:.1%} and {shares[1]:.1%})"
    return [*out, ("3.7", title, found.orderBy("item"), SHOWN["ordinated"])]


def sections(fact: DataFrame, n_samples: int, flags: DataFrame, ppm: float = 1000.0, abs_flags: DataFrame | None = None, tier_flags: DataFrame | None = None, names: DataFrame | None = None, cluster: str = "none") -> list[tuple[str, str, DataFrame, int]]:
    """Number, title, rows and how many are shown, of each section."""
    species, stats = cohort.species(fact, n_samples, flags), cohort.sample_stats(fact)
    informative = ("Bacteria", "Archaea", "Viruses", "Fungi", "Protists")
    by = stats.join(cohort.dominant_domain(fact, informative), "sample_id").groupBy("domain").agg(F.count("*").alias("samples"), *(F.percentile("pct_nonhuman", q).alias(f"q{int(q * 100):02d}") for q in (0.05, 0.25, 0.5, 0.75, 0.95)))
    either = flags.select("sample_id") if abs_flags is None else flags.select("sample_id").union(abs_flags.select("sample_id"))
    out = [
        ("1", "Executive summary", cohort.executive(stats, species), 1),
        ("3.1", "Species summary", species.orderBy(*cohort.by_burden()), SHOWN["species"]),
        ("3.2", "Prevalence and burden", reporting.quadrants(species, fact.where("abs IS NOT NULL").limit(1).count() > 0).orderBy("quadrant", F.desc("level"), "tax_id"), SHOWN["species"]),
        ("3.3", "Rank abundance", cohort.rank_abundance(species).select("rank", "tax_id", "raw_total"), SHOWN["species"]),
        ("3.4", "Core, accessory and rare", cohort.top_of_bands(species, SHOWN["bands"]).select("band", "rank", "tax_id", "prevalence", "burden").orderBy("band", "rank"), 3 * SHOWN["bands"]),
        ("3.5", "Distributions by dominant domain", by.orderBy("domain"), 20),
        ("3.6", "Domain composition", cohort.composition(fact).orderBy("sample_id", F.desc("reads")), SHOWN["samples"]),
        ("3.6.2", "Prevalence and CPM", reporting.scatter(species, SHOWN["species"]), SHOWN["species"]),
        ("3.6.3", "Burden by domain", reporting.burden_by_domain(fact).orderBy(F.desc("samples"), "domain"), 20),
        ("3.6.4", "Diversity", reporting.diversity(stats).orderBy("measure", "bin"), 40),
        ("3.9", "Labels of most reads", reporting.means(fact, n_samples), 10),
        ("4", "Variant impact", cohort.over_threshold(stats, ppm).orderBy(F.desc("abs_ppm"), "sample_id"), SHOWN["samples"]),
        ("5", "Detection", flags.orderBy("method", "tax_id", "sample_id"), SHOWN["flags"]),
        ("6", "Notable samples", reporting.notable(stats, either, SHOWN["notable"]).orderBy("list", "rank"), 4 * SHOWN["notable"]),
    ]
    over = cohort.over_threshold(stats, ppm)
    at = [n for n, *_ in out].index("5")
    out[at:at] = [
        ("3.8", "Drill-down", reporting.drill_down(fact, species).orderBy("place", "rank"), 250),
        ("4.1", "Burden, logarithmic", reporting.burden_histogram(stats).orderBy("bin"), 30),
        ("4.2", "Reads of those samples by label", cohort.top_and_others(fact.join(over.select("sample_id"), "sample_id", "left_semi"), fact.select("tax_id").distinct().withColumn("name", F.lit(None).cast("string")) if names is None else names).orderBy(F.desc("reads"), "label"), 11),
    ]
    out.insert(1, ("1.1", "Domains", reporting.domain_mix(fact).orderBy(F.desc("reads"), "domain"), 20))
    out.insert(-1, ("5.2", "Detection, counts", reporting.detection_overview(flags, abs_flags).orderBy("what"), 20))
    if cluster != "none":
        out += ordered(fact, species, n_samples, cluster)
    if tier_flags is not None:
        out.insert(-1, ("5.1", "Agreement of tiers", reporting.flag_agreement(flags, tier_flags).orderBy("tier"), 100))
    if names is not None:
        out.append(("7", "Discussion", reporting.discussion(species, names).orderBy("band", "rank"), 6))
    return out


#: What a run's summary calls its counts.
COUNTED = {"samples": "Samples", "taxa_in_matrix": "Taxa in Matrix", "detection_method": "Detection Method", "flagged_pairs": "Flagged (sample, taxon) Pairs", "quarantined_samples": "Quarantined Samples", "timestamp": "Timestamp (UTC)"}


def multiqc(counted: dict) -> str:
    """A run's counts as a custom table of MultiQC."""
    table = {"id": "tallytree", "section_name": "Cohort run", "plot_type": "table", "pconfig": {"id": "tallytree_summary", "title": "Cohort run"}, "data": {"Pipeline Run": {name: counted[c] for c, name in COUNTED.items()}}}
    return json.dumps({"custom_data": {"tallytree": table}}, indent=2)


def render(title: str, parts: list[tuple[str, str, DataFrame, int]]) -> str:
    body = "".join(section(*p) for p in parts)
    return f"<!DOCTYPE html><html><head><meta charset='utf-8'><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>{body}</body></html>"


def manifest(species: DataFrame, flags: DataFrame, n_samples: int, tiers: list[str] | tuple[str, ...] = ()) -> str:
    bands = {r["band"]: r["count"] for r in species.groupBy("band").count().collect()}  # three rows
    top = species.orderBy(*cohort.by_burden()).limit(SHOWN["species"]).select("tax_id", "prevalence", "raw_total", "burden", "band").toArrow().to_pylist()
    flagged = [r[0] for r in flags.select("sample_id").distinct().orderBy("sample_id").limit(SHOWN["flags"]).collect()]
    return json.dumps({"schema_version": "2.2", "samples": n_samples, "bands": bands, "flagged": flags.select("sample_id").distinct().count(), "flagged_samples": flagged, "tiers": list(tiers), "species": top}, indent=2)
