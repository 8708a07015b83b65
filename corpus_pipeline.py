"""Filters a corpus in stages, each of which is one of the corpus operators.

Of every stage: it takes the columns of ``documents`` (``COLUMNS``) and returns them
but for the last one; other columns, also such as are called like one that an
operator adds, are left out. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallytree.llm import decontaminate, near_duplicates, packing, passages, quality, repeats
from tallytree.llm.common import table, written
from tallytree.llm.decontaminate import sized

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose quality score is under 0.3.

    A null or empty text is scored as an empty one and goes or stays by that; equal
    texts share one score; a null doc_id is scored and kept like any other. Without
    labels all have one score, the labels' share."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.quality_scores(docs, model, keep=COLUMNS).where("score >= 0.3").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (similarity 0.8, five
    words): the one of the smallest doc_id, a null one being last. Rows are told
    apart by doc_id and text, so different texts of one doc_id, or without one,
    are documents of their own; of rows that repeat both, one is kept."""
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row"))
    again = written(keyed.groupBy("row").count().where("count > 1").select(F.col("row").alias("again")))
    repeated = sized(again)
    once = keyed.join(repeated, F.col("row") == F.col("again"), "left_anti")
    docs = once.unionByName(written(keyed.join(repeated, F.col("row") == F.col("again"), "left_semi").dropDuplicates(["row"])))
    told = near_duplicates.near_duplicates(docs, percent=80, key="row")
    copies = written(told.where("NOT kept").select("row", F.col("component_id").alias("of")))
    members = written(copies.unionByName(copies.select(F.col("of").alias("row"), "of").distinct()))
    named = sized(members.withColumnRenamed("row", "at")).join(docs.select("row", "doc_id"), F.col("at") == F.col("row"))
    best = named.groupBy("of").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")).alias("best"))
    best = written(best.select(F.col("best.row").alias("best")))
    gone = written(members.join(sized(best), F.col("row") == F.col("best"), "left_anti").select(F.col("row").alias("gone")))
    return docs.join(sized(gone), F.col("row") == F.col("gone"), "left_anti").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out every passage of 400 bytes or more that occurs again, and every one of
    over 50 words that another document has; a document of which nothing is left goes.

    A null or empty text stays, as an empty one. Rows that repeat lose what they
    share, so texts of 400 bytes or more go with their copies (the stage before
    leaves one of each). Rows without a doc_id are told apart by text."""
    found = repeats.remove_repeats(docs, keep=COLUMNS, also=passages.repeated_passages)
    found = found.where("n_bytes = 0 OR text != ''").withColumn("n_chars", F.length("text").cast("long"))
    return found.select(*COLUMNS)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents of which a twentieth or more stands in the benchmark.

    A null or empty text has no words and stays. Rows are told apart by doc_id
    (null, too) and text; those that repeat share one fate. An empty benchmark
    rejects nothing."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = written(found.where(decontaminate.contaminated()).select(F.col("doc_id").alias("bad"), F.col("row").alias("bad_row")).distinct())
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(*COLUMNS).join(sized(bad), F.col("doc_id").eqNullSafe(F.col("bad")) & (text == F.col("bad_row")), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What was kept, packed into sequences of 4096 tokens along the curve: a row a
    piece, with a checksum of its ids.

    A null or empty text is the end's id alone; rows that repeat are packed each;
    a null doc_id stays one."""
    return packing.pack(docs).withColumn("ids_crc32", F.crc32("ids"))


#: (name, function of (spark, docs, sf_dir)): each works on what the one before it kept.
STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", uncontaminated),
    ("packing", packed),
]

#: Learned and iterative stages are beyond SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
