"""The label tree: closure, roll-up, domains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Anchors of the domains, first match counts.
DOMAINS = ((2, "Bacteria"), (2157, "Archaea"), (10239, "Viruses"), (81077, "UniVec_Core"))
EUKARYOTES = ((9606, "Human"), (4751, "Fungi"), (33208, "Metazoa_other"), (33090, "Viridiplantae"))
EUKARYOTA = 2759


def closure(nodes: DataFrame, most: int = 64) -> DataFrame:
    """``tax_id``, ``ancestor_id``, ``depth`` (0: itself) of a tree (tax_id,
    parent_id) whose root is its own parent. Ancestors double each round; a
    cycle ends after ``most`` steps up."""
    steps = nodes.where("tax_id <> parent_id").select("tax_id", "parent_id").distinct()
    known = nodes.select(F.explode(F.array("tax_id", "parent_id")).alias("tax_id")).distinct()
    out = known.select("tax_id", F.col("tax_id").alias("ancestor_id"), F.lit(0).alias("depth"))
    jump, span = steps.select("tax_id", F.col("parent_id").alias("ancestor_id")), 1
    while span < most:
        # out reaches depth span - 1; jump goes exactly span up
        further = out.alias("o").join(jump.alias("j"), F.col("o.ancestor_id") == F.col("j.tax_id")).select("o.tax_id", "j.ancestor_id", (F.col("o.depth") + span).alias("depth"))
        # kept, as each round reads the one before it three times
        out = out.unionByName(further).groupBy("tax_id", "ancestor_id").agg(F.min("depth").alias("depth")).persist()
        jump = jump.alias("a").join(jump.alias("b"), F.col("a.ancestor_id") == F.col("b.tax_id")).select("a.tax_id", "b.ancestor_id").distinct().persist()
        span *= 2
        if jump.isEmpty():
            break
    return out


def roll_up(direct: DataFrame, lineage: DataFrame, *keys: str) -> DataFrame:
    """``keys``, ``tax_id``, ``clade_reads``: each direct count added to every
    ancestor. A label outside the tree counts for itself alone."""
    to = lineage.select("tax_id", "ancestor_id")
    up = direct.join(to, "tax_id", "left").select(*keys, F.coalesce("ancestor_id", "tax_id").alias("tax_id"), "direct_reads")
    return up.groupBy(*keys, "tax_id").agg(F.sum("direct_reads").alias("clade_reads"))


def domains(labels: DataFrame, lineage: DataFrame, anchors=DOMAINS, eukaryota: int = EUKARYOTA, eukaryotes=EUKARYOTES) -> DataFrame:  # noqa: ANN001
    """``tax_id`` and ``domain`` of each label, by the first anchor on its lineage."""
    wanted = [a for a, _ in (*anchors, *eukaryotes)] + [eukaryota]
    at = labels.select("tax_id").distinct().join(lineage.where(F.col("ancestor_id").isin(wanted)), "tax_id", "left")
    got = at.groupBy("tax_id").agg(F.collect_set("ancestor_id").alias("up"))
    has = lambda a: F.array_contains("up", F.lit(a).cast("long"))
    name = F.when(F.col("tax_id") == 0, "Unclassified")
    for anchor, label in anchors:
        name = name.when(has(anchor), label)
    for anchor, label in eukaryotes:
        name = name.when(has(eukaryota) & has(anchor), label)
    return got.select("tax_id", name.when(has(eukaryota), "Protists").otherwise("Unclassified").alias("domain"))
