"""Types of the tables, and the names that callers may pass."""

from __future__ import annotations

#: Rank codes, default rank filter, matrix types, detection methods.
RANKS = ("U", "R", "D", "P", "C", "O", "F", "G", "S")
DEFAULT_RANKS = ("S", "G", "F")
MATRIX_TYPES = ("raw", "cpm", "abs")
METHODS = ("mad", "iqr", "gmm")
#: Long rank names and their codes.
RANK_CODES = {"superkingdom": "D", "domain": "D", "kingdom": "K", "phylum": "P", "class": "C", "order": "O", "family": "F", "genus": "G", "species": "S"}
#: Taxa with a meaning of their own.
UNCLASSIFIED, ROOT, HUMAN = 0, 1, 9606

REPORT = "sample_id string, source_path string, line_ord long, percentage double, clade_reads long, direct_reads long, rank string, tax_id long, name string"
READS = "sample_id string, source_path string, status string, read_id string, tax_id long, length string, kmers string"
NODES = "tax_id long, parent_id long, rank string"
SUMMARY = "schema_version string, sample_id string, input string, extraction_time string, total_mapped long, total_unmapped long, total_reads long, per_chromosome array<struct<chrom:string,length:long,mapped:long,unmapped:long>>"
FLAGS = ("sample_id", "tax_id", "taxon_name", "value", "population_median", "deviation", "method")


def checked_ranks(ranks: list[str] | tuple[str, ...]) -> list[str]:
    wrong = [r for r in ranks if r and r not in RANKS]
    if wrong:
        raise ValueError(f"unknown rank codes: {', '.join(wrong)}; known are {', '.join(RANKS)}")
    return [r for r in ranks if r]


def checked_threshold(value: float) -> float:
    if not 0.0 <= value <= 1.0:
        raise ValueError(f"a confidence threshold is between 0 and 1, not {value}")
    return float(value)


def tier_suffix(threshold: float) -> str:
    """Two decimals only: thresholds closer than that share a suffix."""
    return "conf" + f"{threshold:.2f}".replace(".", "p")
