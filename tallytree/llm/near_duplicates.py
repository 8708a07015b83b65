"""MinHash near-duplicates by a multi-index Hamming join.

A text's set of word shingles has a signature of min-hashes, each kept as a
symbol of 16 bits. Signatures are cut into chunks; by the pigeonhole principle,
two that differ in at most ``m * (e + 1) - 1`` of their symbols have one of ``m``
chunks with at most ``e`` errors, so that one of the keys that leave out every
choice of ``e`` symbols of that chunk is equal. That finds all pairs under the
distance; every pair found is then measured on the full sets.

Within a key, texts are first measured against the key's centre, in a crowded key
against several (drawn by hashes of the id, so that neighbouring keys share them).
What that puts into one component needs no more comparing; of the rest of a key,
pairs of different components are compared: all of them in a key of ``CROWD`` texts
at most. Texts of larger keys get a second index of longer chunks. Where that has
crowded keys, too, texts are compared through the elements in which each differs
from a centre: a prefix filter leaves the pairs that can be similar. No key, bucket
or partner is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, lean, mix, slices, steps, texts, written
from .decontaminate import sized
from .wordhash import SPACED, span_hashes, sums, word_spans

#: Chance that an index misses a pair of exactly the linking similarity.
MISS = 1e-6
#: Texts of a key up to which all its pairs are measured.
CROWD = 40
#: Centres of a larger one, beside the least id.
DRAWS = 5
#: Pairs of one text that a task takes; the text's set is copied for each such share.
SHARE = 1000
#: Keys of a crowded text's second index at most.
SHARP_KEYS = 56


@dataclass(frozen=True)
class Index:
    """Chunks of ``symbols`` with ``errors`` allowed in each, and how many chunks."""

    symbols: int
    errors: int
    chunks: int
    seed: int

    @property
    def distance(self) -> int:
        """Signatures that differ in so many symbols at most always share a key."""
        return self.chunks * (self.errors + 1) - 1


def index(similarity: float, symbols: int, errors: int, seed: int) -> Index:
    """As many chunks as ``MISS`` asks for."""
    good = sum(math.comb(symbols, e) * (1 - similarity) ** e * similarity ** (symbols - e) for e in range(errors + 1))
    return Index(symbols, errors, math.ceil(math.log(MISS) / math.log(1 - good)), seed)


def sharp_index(similarity: float, seed: int) -> Index:
    """The longest chunks without errors that need ``SHARP_KEYS`` keys at most."""
    n = 1
    while index(similarity, n + 1, 0, seed).chunks <= SHARP_KEYS:
        n += 1
    return index(similarity, n, 0, seed)


def shingles(raw: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of the distinct shingles of each text, in that order. A text
    of fewer than ``size`` words has one shingle, the whole sequence."""
    start, end, doc = word_spans(raw, off, SPACED)
    h = span_hashes(sums(raw, lower=True), start, end)
    n = np.bincount(doc, minlength=len(off) - 1)
    first = np.cumsum(n) - n
    take = np.minimum(size, n[doc] - (np.arange(len(h)) - first[doc]))  # words from here on
    joined = np.zeros(len(h), np.uint64)
    for k in range(size):
        there = np.flatnonzero(take > k)
        joined[there] = mix(joined[there] * np.uint64(0x100000001B3) + h[there + k])
    whole = (take == size) | ((n[doc] < size) & (np.arange(len(h)) == first[doc]))
    doc, joined = doc[whole], joined[whole]
    order = np.lexsort((joined, doc))
    doc, joined = doc[order], joined[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (joined[1:] != joined[:-1])
    return doc[new], joined[new]


def keys_of(doc: np.ndarray, h: np.ndarray, n: int, idx: Index) -> np.ndarray:
    """The index's keys of each text, a row each; texts without shingles have zeros."""
    rng = np.random.default_rng(idx.seed)
    size = np.bincount(doc, minlength=n)
    some = np.flatnonzero(size)
    first = (np.cumsum(size) - size)[some]
    left_out = list(combinations(range(idx.symbols), idx.errors))
    out = np.zeros((n, idx.chunks * len(left_out)), np.uint64)
    for c in range(idx.chunks if len(some) else 0):
        symbols = []
        for _ in range(idx.symbols):
            a, b = rng.integers(0, 1 << 63, 2, dtype=np.int64).astype(np.uint64)
            least = np.minimum.reduceat((h ^ b) * (a * np.uint64(2) + np.uint64(1)), first)
            symbols.append(mix(least) >> np.uint64(48))  # the least of many is itself no even draw
        for k, gone in enumerate(left_out):
            key = np.full(len(some), c * len(left_out) + k + 1, np.uint64)
            for i in range(idx.symbols):
                if i not in gone:
                    key = mix(key * np.uint64(0x100000001B3) + symbols[i])
            out[some, c * len(left_out) + k] = key
    return out


def signed(rows: DataFrame, size: int, idx: Index) -> DataFrame:
    """``key``, ``id``, ``n`` (shingles), ``digest`` of the set (128 bits), and ``keys``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for at, to, raw, off in steps(b.column("text")):
                doc, h = shingles(raw, off, size)
                n = to - at
                count, keys = np.bincount(doc, minlength=n), keys_of(doc, h, n, idx)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column("key").slice(at, n), b.column("id").slice(at, n), pa.array(count), digests(doc, h, n), flat], names=["key", "id", "n", "digest", "keys"])

    return rows.mapInArrow(lean(run), "key long, id long, n long, digest binary, keys array<long>")


def digests(doc: np.ndarray, h: np.ndarray, n: int) -> pa.Array:
    """128 bits of each text's set."""
    out = np.zeros((n, 2), np.uint64)
    np.add.at(out[:, 0], doc, h)
    np.add.at(out[:, 1], doc, mix(h ^ np.uint64(0x5851F42D4C957F2D)))
    return pa.array([d.tobytes() for d in out], pa.binary())


def sets_of(rows: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """``id``, ``u`` (a number of the set), ``s`` (the set) of the rows whose id is in ``ids``."""
    needed = rows.join(sized(ids.select(F.col("id").alias("at"))), F.col("id") == F.col("at"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for at, to, raw, off in steps(b.column("text")):
                doc, h = shingles(raw, off, size)
                cut = np.searchsorted(doc, np.arange(to - at + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("id").slice(at, to - at), digests(doc, h, to - at), pa.ListArray.from_arrays(pa.array(cut), pa.array(h.view(np.int64)))], names=["id", "digest", "s"])

    found = needed.select("id", "text").mapInArrow(lean(run), "id long, digest binary, s array<long>").dropDuplicates(["id", "digest"])
    return found.select("id", F.xxhash64("digest").alias("u"), "s")


def sharper(full: DataFrame, idx: Index) -> DataFrame:
    """``id`` and ``key`` of the second index, of sets (id, s)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            sets = b.column("s")
            sizes = sets.value_lengths().to_numpy(zero_copy_only=False)
            h = sets.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            keys = keys_of(np.repeat(np.arange(len(sizes)), sizes), h, len(sizes), idx)
            yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(np.repeat(np.arange(len(sizes)), keys.shape[1]))), pa.array(keys.ravel().view(np.int64))], names=["id", "key"])

    return full.select("id", "s").mapInArrow(lean(run), "id long, key long")


def dealt(rows: DataFrame, sets: DataFrame, on: str, pairs: DataFrame) -> DataFrame:
    """``rows`` joined with ``sets`` (one row an id ``on``). The rows of an id that has
    more than ``SHARE`` are dealt by hash to copies of its set, so that a centre's
    members don't meet in one task. ``pairs`` are the rows' own ids, written."""
    shares = F.ceil(F.count("*") / SHARE)
    many = written(pairs.groupBy(F.col(on).alias("many")).agg(shares.alias("shares")).where("shares > 1"))
    few = sized(many)
    met = rows.join(few, F.col(on) == F.col("many"), "left").withColumn("share", F.pmod(F.xxhash64(*pairs.columns), F.coalesce("shares", F.lit(1)))).select(*rows.columns, "share")
    copies = sets.join(few, F.col(on) == F.col("many"), "left").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("shares", F.lit(1)) - 1))).select(*sets.columns, "share")
    return met.join(copies, [on, "share"]).drop("share")


def links(full: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets have 100 * intersection >= percent * union."""
    one = dealt(pairs, full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a", pairs)
    both = dealt(one, full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b", pairs)
    # row by row in the JVM: a batch of pairs of whole sets would be hundreds of MB
    same = F.size(F.array_intersect("sa", "sb"))
    alike = 100 * F.least(F.size("sa"), F.size("sb")) >= percent * F.greatest(F.size("sa"), F.size("sb"))
    return written(both.where(alike & (100 * same >= percent * (F.size("sa") + F.size("sb") - same))).select("a", "b"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``comp``, the smallest node that it can reach, of all nodes of
    edges (a, b). Each round hangs every node under its smallest smaller
    neighbour, jumps to the roots, and contracts the edges to what is left
    between roots; rounds and jumps grow with the logarithm of the nodes."""
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    found = written(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select("node", F.col("node").alias("comp")))
    while not edges.isEmpty():
        parent = written(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("up")).withColumn("moved", F.lit(True)))
        while not parent.where("moved").isEmpty():
            above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            jumped = written(parent.drop("moved").join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")))
            discard(parent)
            parent = jumped
        root = lambda c, p=parent: p.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up"))
        to = written(found.join(root("comp"), "comp", "left").select("node", F.coalesce("comp_up", "comp").alias("comp")))
        left = edges.join(root("a"), "a", "left").join(root("b"), "b", "left").select(F.coalesce("a_up", "a").alias("x"), F.coalesce("b_up", "b").alias("y"))
        left = written(left.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct())
        discard(found, edges, parent)
        found, edges = to, left
    discard(edges)
    return found


def like_size(a: str, b: str, percent: int) -> F.Column:
    """Whether sets of two sizes can be similar enough."""
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def apart(n: F.Column, percent: int) -> F.Column:
    """Elements in which two similar sets of ``n`` elements together differ at most."""
    return F.floor(n * (100 - percent) / (100 + percent))


def within(told: DataFrame, percent: int) -> DataFrame:
    """Pairs of members (key, id, n, comp) of each key and different components."""
    other = told.select("key", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("comp").alias("comp_b"))
    met = told.join(other, "key").where((F.col("comp") < F.col("comp_b")) & like_size("n", "n_b", percent))
    return met.select(F.least("id", "b").alias("a"), F.greatest("id", "b").alias("b")).distinct()


def around(full: DataFrame, crowd: DataFrame, percent: int) -> DataFrame:
    """Pairs of members (c, id, comp) of one centre and different components that
    can be similar, and of members with the centre where they are. None is missed.

    Sets x and y that differ from the centre's in dx and dy elements and from
    each other in t at most have (dx + dy - t) / 2 of these differences in
    common. If that is no more than none, both are similar to the centre; else, with
    all differences in one order, rarest first, the first dx - common + 1 of x
    and the first dy - common + 1 of y share one. A set that has less in common
    with the centre than not is taken by its own elements instead (the centre is
    then the empty set); one at the border, by both.
    """
    sets = full.select("id", "u", "s")
    met = dealt(crowd.join(sets, "id"), sets.select(F.col("id").alias("c"), F.col("u").alias("uc"), F.col("s").alias("sc")), "c", crowd)
    n, off = F.size("s"), F.concat(F.array_except("s", "sc"), F.array_except("sc", "s"))
    met = met.select("id", "c", "comp", "u", "uc", "s", n.alias("n"), F.size("sc").alias("nc"), off.alias("off"))
    d, most = F.size("off"), apart(F.floor(F.col("n") * (100 + percent) / percent), percent)
    none = F.expr("cast(array() as array<bigint>)")
    to_centre = F.when(d * percent <= F.col("n") * 100 + most * percent, F.col("off")).otherwise(none)
    to_none = F.when(d >= F.col("n"), F.col("s")).otherwise(none)
    met = met.select("id", "c", "comp", "u", "uc", "n", most.alias("most"), (d <= apart(F.col("n") + F.col("nc"), percent)).alias("near"), to_centre.alias("p0"), to_none.alias("p1"))
    met = written(met)
    parts = met.select("id", "near", "comp", "u", "uc", "n", "most", F.explode(F.array(*(F.struct(F.lit(k).alias("part"), F.col(f"p{k}").alias("of")) for k in (0, 1)))).alias("p"))
    parts = written(parts.select("id", "near", "comp", "u", "uc", "n", "most", "p.part", F.size("p.of").alias("d"), F.explode("p.of").alias("e")))
    # what no other has comes first in the order and can't be shared
    often = written(parts.groupBy("uc", "part", "e").agg(F.count("*").alias("often")).where("often > 1"))
    own = Window.partitionBy("uc", "part", "id", "u")
    first = parts.join(often, ["uc", "part", "e"])
    first = first.withColumn("at", F.col("d") - F.count("*").over(own) + F.row_number().over(own.orderBy("often", "e"))).where(F.col("at") <= F.col("most") + 1)
    first = written(first.drop("often", "most"))
    other = first.select("uc", "part", "e", *(F.col(c).alias(f"{c}_b") for c in ("id", "near", "comp", "n", "d", "at")))
    common = F.greatest(F.lit(1), F.ceil((F.col("d") + F.col("d_b") - apart(F.col("n") + F.col("n_b"), percent)) / 2))
    pair = (F.col("near_b") | (F.col("id") < F.col("id_b"))) & (F.col("comp") != F.col("comp_b")) & like_size("n", "n_b", percent)
    pair &= (F.col("at") <= F.col("d") - common + 1) & (F.col("at_b") <= F.col("d_b") - common + 1)
    found = first.where("NOT near").join(other, ["uc", "part", "e"]).where(pair).select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b"))
    found = found.unionByName(met.where("near AND id != c").select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")))
    out = written(found.distinct())
    discard(met, parts, often, first)
    return out


def near_duplicates(docs: DataFrame, percent: int = 80, size: int = 5, key: str = "doc_id") -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of each document.

    Words are what white space (ASCII) separates, A-Z lower-cased; a set holds
    the distinct shingles of ``size`` words. Documents are linked where
    100 * intersection >= percent * union; ``component_id`` is the smallest key
    that can be reached, and ``kept`` says that it is the document's own.

    Fewer than ``size`` words: the whole sequence is one shingle. Null or empty
    texts, or texts of white space, have empty sets, are linked with nothing
    and kept; so are rows with a null key. Rows that repeat have equal results
    each; rows of one key and different texts are one document, linked where any
    of its texts is. An empty table gives an empty one. Other columns are ignored.
    """
    number = F.col(key).cast("long")
    # ids are the keys, stirred (one to one), so that the least of a group is an even draw
    rows = texts(docs, key).select(number.alias("key"), F.when(number.isNotNull(), F.xxhash64(number)).alias("id"), "text")
    found = written(signed(rows, size, index(percent / 100, 5, 1, 17)))
    real = found.where("n > 0 AND key IS NOT NULL")
    classes = written(real.groupBy("digest", "n").agg(F.min("key").alias("low"), F.first("keys").alias("keys")).withColumn("id", F.xxhash64("low")))
    keyed = classes.select("id", F.col("n").cast("int").alias("n"), F.explode(F.array_distinct("keys")).alias("key"))

    shared = keyed.groupBy("key").agg(F.min("id").alias("c"), F.count("*").alias("times")).where("times > 1")
    members = written(keyed.join(shared.hint("shuffle_hash"), "key"))
    full = written(sets_of(rows, written(members.select("id").distinct()), size))
    few, many = members.where(F.col("times") <= CROWD), members.where(F.col("times") > CROWD)
    drawn = [F.xxhash64("id", F.lit(k)) for k in range(DRAWS)]
    least = written(many.groupBy("key").agg(*(F.min(d).alias(f"least{k}") for k, d in enumerate(drawn))))
    is_centre = (F.col("id") == F.col("c")) | F.exists(F.array(*(d == F.col(f"least{k}") for k, d in enumerate(drawn))), lambda x: x)
    centres = many.join(least, "key").where(is_centre).groupBy("key").agg(F.collect_set(F.struct("id", "n")).alias("centres"))  # DRAWS + 1 at most
    centres = written(centres)
    # a text has the same centres under most of its keys: once each
    met = many.select("key", "id", "n").join(centres, "key").groupBy("id", "n").agg(F.array_distinct(F.flatten(F.collect_set("centres"))).alias("centres"))
    met = met.select(F.col("id").alias("a"), "n", F.explode("centres").alias("c")).select("a", "n", F.col("c.id").alias("b"), F.col("c.n").alias("n_b"))
    met = met.where((F.col("a") != F.col("b")) & like_size("n", "n_b", percent)).select("a", "b")
    stars = written(few.where("id != c").select(F.col("id").alias("a"), F.col("c").alias("b")).unionByName(met).distinct())
    first = links(full, stars, percent)
    joined = components(first)

    placed = written(members.join(joined.withColumnRenamed("node", "id"), "id", "left").select("key", "id", "n", "times", F.coalesce("comp", "id").alias("comp")))
    mixed = written(placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key"))
    told = placed.join(mixed, "key", "left_semi")
    # of a text's centres the one that most texts are near
    popular = first.groupBy(F.col("b").alias("centre")).agg(F.count("*").alias("near"))
    best = centres.select("key", F.explode("centres.id").alias("centre")).join(popular, "centre", "left")
    best = written(best.groupBy("key").agg(F.max(F.struct(F.coalesce("near", F.lit(0)).alias("near"), "centre")).alias("best")))
    crowd = written(told.where(F.col("times") > CROWD).join(best, "key").groupBy("id", "n", "comp").agg(F.max("best").alias("best")))
    again = written(sharper(full.join(sized(crowd.select("id")), "id", "left_semi"), sharp_index(percent / 100, 18)).distinct().join(crowd, "id"))
    groups = again.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("times"), F.max("best")["centre"].alias("c")).where("low < high")
    groups = written(groups.select("key", "times", "c"))
    again = again.join(groups, "key")
    pairs = within(told.where(F.col("times") <= CROWD), percent).unionByName(within(again.where(F.col("times") <= CROWD), percent))
    pairs = written(pairs.unionByName(around(full, written(again.where(F.col("times") > CROWD).select("c", "id", "comp").distinct()), percent)).distinct())
    second = links(full, pairs, percent)
    linked = written(first.unionByName(second))
    joined = components(linked)

    named = classes.select("id", "low").join(joined, F.col("id") == F.col("node"))
    lowest = written(named.groupBy("comp").agg(F.min("low").alias("least")))
    comp = classes.select("digest", "n", "id", "low").join(joined, F.col("id") == F.col("node"), "left").join(lowest, "comp", "left")
    comp = comp.select(F.col("digest").alias("d"), F.col("n").alias("of"), F.coalesce("least", "low").alias("comp"))
    out = found.select("key", "n", "digest").join(comp, (F.col("digest") == F.col("d")) & (F.col("n") == F.col("of")), "left")
    own = F.when(F.col("key").isNotNull(), F.coalesce("comp", "key"))
    out = out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"), F.col("key").eqNullSafe(own).alias("kept"))
    discard(members, full, least, centres, stars, first, placed, mixed, best, crowd, groups, pairs, second, linked)
    return out
