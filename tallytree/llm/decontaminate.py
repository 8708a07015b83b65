"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Words are hashed, every ``GRAM`` consecutive words give a gram's hash, and of
each ``WINDOW`` consecutive grams the smallest hash is a fingerprint. Two texts
that share ``GRAM + WINDOW - 1`` consecutive words share a fingerprint, so a join
of fingerprints finds every document that can hold a window of the benchmark.
Hits are then extended: the whole windows of those documents are joined with
the benchmark's by 128 bits of hashes, which gives the exact words covered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, texts, written

SPAN, GRAM = 13, 8
WINDOW = SPAN - GRAM + 1
#: Rows up to which a side of a join is broadcast (16 to 24 bytes each); beyond it both are shuffled.
BROADCAST_ROWS = 400_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: str = "text") -> Column:
    """A-Z lower-cased; words are runs of digits, letters, and all that isn't ASCII."""
    return F.array_remove(F.split(F.translate(F.col(text), UPPER, LOWER), BETWEEN), "")


def grams(column: str, n: int) -> Column:
    """A hash of every n consecutive elements of an array; none if it is shorter."""
    parts = ", ".join(f"{column}[i + {k}]" for k in range(n))
    return F.expr(f"if(size({column}) < {n}, array(), transform(sequence(0, size({column}) - {n}), i -> xxhash64({parts})))")


def hashed(rows: DataFrame) -> DataFrame:
    """Adds ``h``, the hashes of the text's words, and drops the text."""
    return rows.withColumn("w", words()).withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).drop("text", "w")


def winnowed(g: str = "g") -> Column:
    """The smallest of each ``WINDOW`` consecutive hashes, each once."""
    least = ", ".join(f"{g}[j + {k}]" for k in range(WINDOW))
    return F.expr(f"if(size({g}) < {WINDOW}, array(), array_distinct(transform(sequence(0, size({g}) - {WINDOW}), j -> least({least}))))")


def marked(hashes: Column, span: int) -> Column:
    """Hashes as (span, f)."""
    return F.transform(hashes, lambda f: F.struct(F.lit(span).alias("span"), f.alias("f")))


def placed(n: int) -> Column:
    """Every window of n words: pos, span, g, g2."""
    pairs = F.arrays_zip(grams("h", n).alias("g"), grams("h2", n).alias("g2"))
    return F.transform(pairs, lambda p, i: F.struct(i.alias("pos"), F.lit(n).alias("span"), p["g"].alias("g"), p["g2"].alias("g2")))


def windows_of(rows: DataFrame, lengths: list[int], *keys: str) -> DataFrame:
    """``keys``, ``pos``, ``span``, ``g`` and ``g2``: every window of so many words, with two hashes."""
    both = rows.withColumn("w", words()).withColumn("h", F.transform("w", lambda x: F.xxhash64(x))).withColumn("h2", F.transform("w", lambda x: F.xxhash64(F.lit(2), x)))
    return both.select(*keys, F.explode(F.concat(*map(placed, lengths))).alias("at")).select(*keys, "at.*")


def contaminated() -> Column:
    """A twentieth or more of a document's words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcasting if it has few rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def asked_of(rows: DataFrame, key: str, short: list[int]) -> DataFrame:
    """``key``, ``row``, ``n_words``, ``span`` and ``f``: each text's fingerprints (span
    0), every gram of the lengths of shorter items, which are beyond any winnowing
    guarantee, and a row for the text itself (span -1, met by nothing). That one has
    the text's hash, so that a join that shuffles deals these rows evenly."""
    itself = F.array(F.struct(F.lit(-1).alias("span"), F.col("row").alias("f")))
    asked = F.concat(itself, marked(winnowed(), 0), *(marked(grams("h", n), n) for n in short))
    return hashed(rows).withColumn("g", grams("h", GRAM)).select(key, "row", F.size("h").alias("n_words"), F.explode(asked).alias("m")).select(key, "row", "n_words", "m.*")


def contamination(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id") -> DataFrame:
    """Which words of each document stand in a benchmark window.

    A window is ``SPAN`` consecutive words of an item; an item of fewer words is
    one window. Columns: ``key``, ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``items`` (ids whose windows occur, sorted as
    strings), ``row`` (xxhash64 of the text).

    Items with a null id are searched like any other; ``items`` then ends in one
    null, which stands for all of them.

    Null and empty texts have no words and no hits; an item without words never
    occurs. Repeated rows have equal results each, rows are told apart by key
    and text; a null key is kept. Empty tables: no rows, or no hits. Other
    columns are ignored.
    """
    rows = texts(docs, key).withColumn("row", F.xxhash64("text"))
    items = texts(benchmark, item).withColumn("n", F.size(words())).where("n > 0").withColumn("item", F.col(item).cast("string")).select("item", "text", "n")
    items = written(items)
    # the windows of every length that items have: SPAN, and those of shorter items
    short = sorted(r[0] for r in items.where(F.col("n") < SPAN).select("n").distinct().collect())  # at most SPAN - 1 numbers
    lengths = [*short, SPAN]
    windows = windows_of(items, lengths, "item", "n").where(F.col("span") == F.least("n", F.lit(SPAN)))
    windows = written(windows.select("item", "span", "g", "g2").distinct())

    # one pass: a row for each text itself (span -1), and for each fingerprint that an item has, too
    some = hashed(items.where(F.col("n") >= SPAN)).withColumn("g", grams("h", GRAM)).select(F.explode(marked(winnowed(), 0)).alias("m")).select("m.*")
    some = some.unionByName(windows.where(F.col("span") < SPAN).select("span", F.col("g").alias("f"))).distinct().withColumn("met", F.lit(True))
    found = asked_of(rows, key, short)
    found = found.join(sized(some), ["span", "f"], "left").where(F.col("met") | (F.col("span") == -1))
    told = written(found.groupBy(key, "row").agg(F.max("n_words").cast("long").alias("n_words"), F.count_if(F.col("span") == -1).cast("int").alias("times"), F.coalesce(F.bool_or("met"), F.lit(False)).alias("met")))

    candidates = written(told.where("met").select(F.col(key).alias("at_key"), F.col("row").alias("at_row")))
    same = F.col(key).eqNullSafe(F.col("at_key")) & (F.col("row") == F.col("at_row"))
    texts_ = rows.join(sized(candidates), same, "left_semi").dropDuplicates([key, "row"])
    hits = written(windows_of(texts_, lengths, key, "row").join(sized(windows.select("span", "g", "g2").distinct()), ["span", "g", "g2"]))
    # words that a window covers beyond those before it
    earlier = Window.partitionBy(key, "row").orderBy("pos", "span").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("pos") + F.col("span")
    new = F.greatest(F.lit(0), end - F.greatest(F.col("pos"), F.coalesce(F.max(end).over(earlier), F.col("pos"))))
    covered = hits.withColumn("new", new).groupBy(key, "row").agg(F.sum("new").cast("long").alias("n_hit"))
    # ids in structs, as collect_set leaves out nulls
    named = hits.select(key, "row", "span", "g", "g2").distinct().join(windows, ["span", "g", "g2"]).select(key, "row", "item").distinct()
    named = named.groupBy(key, "row").agg(F.array_sort(F.transform(F.collect_set(F.struct("item")), lambda x: x["item"])).alias("items"))
    hit = covered.withColumnsRenamed({key: "at_key", "row": "at_row"}).join(named.withColumnsRenamed({key: "of_key", "row": "of_row"}), F.col("at_key").eqNullSafe(F.col("of_key")) & (F.col("at_row") == F.col("of_row")))
    hit = written(hit.select("at_key", "at_row", "n_hit", "items"))
    out = told.join(hit, same, "left").select(key, "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"), "row", "times")
    discard(items, windows, candidates, hits)
    # rows that repeat
    return out.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("_", "times")
