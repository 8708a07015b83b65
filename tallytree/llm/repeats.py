"""Removal of byte strings that occur more than once, by prefix-free parsing.

A rolling hash triggers phrase ends, so equal strings are cut into phrases alike
wherever they stand. Every window of ``LENGTH`` bytes belongs to the first trigger
inside it; the windows that start in one phrase (or in one block of ``WIDTH`` bytes
of a long one) are judged together. They share their core, the right context that
the phrase's end has in all of them, and they cover the phrase with its whole right
context.

- The dictionary has each distinct phrase with its right context once, with the
  number of its places in the parse. What is there twice is repeated as a whole.
- A phrase whose core no other entry has is not repeated at all.
- The other entries are put into corpus order: sorted by the window at the
  phrase's start and, among those equal in it, by the text that follows. The
  longest common prefix with the neighbours in that order says how many of the
  phrase's windows are repeated after the same beginning of the phrase.
- Where phrases with different beginnings go on alike, suffixes of the phrases are
  compared, too: a window there is repeated if it occurs twice among them.

Copies are one entry of the dictionary, so no task meets all copies of a string,
and what is sorted or compared grows with the ends of repeated strings, not with
their copies. A phrase that a text has many times (a line over and over) is one row
of the text with all its places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, kept, lean, matched, mix, slices, steps, texts, written
from .decontaminate import sized
from .wordhash import span_hashes, sums

LENGTH, ROLLING = 400, 16
#: One position in so many triggers; a later one where a window has none of those before.
RATES = (128, 32, 8, 2)
#: Windows that are judged together at most.
WIDTH = 256
#: Bytes of text that one vectorised step handles here, where each byte may be a window with hashes of its own.
STEP = 200_000
#: Windows whose hashes are held at once where phrases are compared window by window.
WINDOWS = 100_000
#: A text is told by its key and a hash of itself, as unlike texts may share a key.
ID = ("id", "row")
#: ``at`` is a phrase's first place in its text, ``more`` has the others (null without any).
PARSE = "core long, full long, full2 long, head long, id long, row long, at long, more array<long>"
ENTRY = (*ID, "at")
#: A phrase's first window ``lo`` and last one ``hi`` are kept as one number ``at``, as ``hi - lo`` is under ``WIDTH``.
BITS = 9


def first_window(at: Column) -> Column:
    return F.shiftright(at, BITS).cast("int")


def last_window(at: Column) -> Column:
    return (F.shiftright(at, BITS) + at.bitwiseAND((1 << BITS) - 1)).cast("int")


def phrases(running: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, and trigger, of each phrase of every text of a step."""
    n = int(off[-1])
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none
    rolling = min(ROLLING, length)
    at = np.arange(n - rolling + 1)
    h = span_hashes(running, at, at + rolling)
    start = np.concatenate([np.arange(a, b - length + 1) for a, b in zip(off, off[1:], strict=False) if b - a >= length] or [none])
    anchor = np.full(len(start), -1)
    open_ = np.arange(len(start))
    for rate in RATES:
        triggers = np.append(np.flatnonzero(h % np.uint64(rate) == 0), np.int64(1) << 60)
        after = triggers[np.searchsorted(triggers, start[open_])]
        has = after <= start[open_] + length - rolling
        anchor[open_[has]] = after[has]
        open_ = open_[~has]
    anchor[open_] = start[open_] - 1  # no trigger at all: a phrase of its own
    block = (anchor - start) // WIDTH
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (block[1:] != block[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return start[first], start[np.append(first[1:], len(start)) - 1] if len(start) else start, anchor[first]


def equal(doc: np.ndarray, one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first of each run of equal phrases of a text, in order of the text, all phrases run
    by run, and how many each run has."""
    n = len(doc)
    order = np.argsort(mix(one + doc.astype(np.uint64)), kind="stable")
    new = np.ones(n, bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (doc, one, two)], axis=0)
    if new.all():
        return np.arange(n), np.arange(n), np.ones(n, np.int64)
    run = np.empty(n, np.int64)
    run[order] = order[new][np.cumsum(new) - 1]  # a run is called by its first phrase
    by_run = np.argsort(run, kind="stable")
    first, counts = np.unique(run, return_counts=True)
    return first, by_run, counts


def parsed(rows: DataFrame, length: int, cores: bool = False) -> DataFrame:
    """The parse: a row for each phrase of a text, with hashes of its core, of all that its
    windows cover (128 bits), and of its first window, and with its places; or the ``cores``
    alone, a row a place."""
    schema = "core long" if cores else PARSE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for at, to, raw, off in steps(b.column("text"), STEP):
                one = sums(raw)
                lo, hi, anchor = phrases(one, off, length)
                doc = np.searchsorted(off, lo, "right") - 1
                near = anchor - (anchor - hi) // WIDTH * WIDTH  # where the block's last window would be
                alone = anchor < lo  # no trigger: its core is the window itself
                core = span_hashes(one, np.where(alone, lo, near), np.where(alone, lo + length, near - WIDTH + 1 + length))
                if cores:
                    yield pa.RecordBatch.from_arrays([pa.array(core.view(np.int64))], names=["core"])
                    continue
                two = sums(raw, which=1)
                place = ((near - hi) * 1024 + (near - lo)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                full = mix(span_hashes(one, lo, hi + length) + place), mix(span_hashes(two, lo, hi + length, 1) ^ place)
                place = (lo - off[doc]) << BITS | (hi - lo)
                first, by_run, counts = equal(doc, *full)
                later = np.ones(len(doc), bool)
                later[np.cumsum(counts) - counts] = False  # of a run all but the first
                upto = np.append(0, np.cumsum(counts - 1)).astype(np.int32)
                more = pa.ListArray.from_arrays(pa.array(upto), pa.array(place[by_run[later]]), mask=pa.array(counts == 1))
                hashes = [pa.array(x[first].view(np.int64)) for x in (core, *full, span_hashes(one, lo, lo + length))]
                ids = [b.column(c).slice(at, to - at).take(pa.array(doc[first])) for c in ID]
                yield pa.RecordBatch.from_arrays([*hashes, *ids, pa.array(place[first]), more], names=[c.split()[0] for c in PARSE.split(", ")])

    return rows.mapInArrow(lean(run), schema)


COMPARED = "a long, b long, tail binary, id long, row long, lo int, lone boolean"
COMPARED_NAMES = [c.split()[0] for c in COMPARED.split(", ")]


def compared(rows: DataFrame, entries: DataFrame, length: int) -> DataFrame:
    """What is compared of entries (id, row, lo, hi, lone, mixed): a row for each, with
    the first window's hash (a, b) and the ``tail`` that follows it; for those that
    are ``mixed`` also a row for each window, with its hash and no tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            for at, to, raw, off in steps(batch.column("text"), STEP):
                parts = batch.column("entries").slice(at, to - at)
                flat, counts = parts.flatten(), parts.value_lengths().to_numpy(zero_copy_only=False)
                base = np.repeat(off[:-1], counts)
                lo, hi = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) + base for f in ("lo", "hi"))
                lone, mixed = (flat.field(f).to_numpy(zero_copy_only=False).astype(bool) for f in ("lone", "mixed"))
                one, two, text = sums(raw), sums(raw, which=1), raw.tobytes()
                ids = [batch.column(c).slice(at, to - at).take(pa.array(np.repeat(np.arange(to - at), counts))) for c in ID]

                def windows(of: np.ndarray, start: np.ndarray, tails: list[bytes | None]) -> pa.RecordBatch:
                    a, b = (pa.array(span_hashes(x, start, start + length, k).view(np.int64)) for k, x in enumerate((one, two)))
                    return pa.RecordBatch.from_arrays([a, b, pa.array(tails, pa.binary()), *(i.take(pa.array(of)) for i in ids), pa.array((start - base[of]).astype(np.int32)), pa.array(lone[of])], names=COMPARED_NAMES)

                yield from slices(iter([windows(np.arange(len(lo)), lo, [text[x + length : y + length] for x, y in zip(lo.tolist(), hi.tolist(), strict=True)])]), 50_000)
                some = np.flatnonzero(mixed)
                n = hi[some] - lo[some] + 1
                upto = np.cumsum(n)
                first = 0
                while first < len(some):  # so many phrases at a time that their windows' hashes stay few
                    last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + WINDOWS, "right")))
                    mine, k = some[first:last], n[first:last]
                    start = np.repeat(lo[mine], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                    yield windows(np.repeat(mine, k), start, [None] * len(start))
                    first = last

    grouped = entries.groupBy(*ID).agg(F.collect_set(F.struct("lo", "hi", "lone", "mixed")).alias("entries"))
    return rows.join(grouped, list(ID)).select(*ID, "text", "entries").mapInArrow(lean(run), COMPARED)


def common_prefix(x: bytes, y: bytes) -> int:
    if x.startswith(y) or y.startswith(x):
        return min(len(x), len(y))
    n = min(len(x), len(y))
    return int(np.argmin(np.frombuffer(x, np.uint8, n) == np.frombuffer(y, np.uint8, n)))


def neighbours_in_order(rows: DataFrame) -> DataFrame:
    """``id``, ``row``, ``lo``, ``lone`` and ``more`` (bytes beyond the first window that a
    neighbour has in common; null without one) of sorted rows (a, b, tail, id, row,
    lo, lone), and whether a row is at the ``edge`` of its partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, before, open_row, first = [*COMPARED_NAMES, "more", "edge"], None, None, True

        def batch(rows_: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.int32(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_, strict=True), kinds, strict=True)], names=names)

        for b in slices(batches, 5000):
            done = []
            for now in zip(*(c.to_pylist() for c in b.columns), strict=True):
                same = None
                if before is not None and before[:2] == now[:2]:
                    same = common_prefix(before[2], now[2])
                if open_row is not None:
                    done.append((*before, max((x for x in (open_row, same) if x is not None and x >= 0), default=None), first))
                    first = False
                open_row, before = -1 if same is None else same, now
            if done:
                yield batch(done)
        if before is not None:
            yield batch([(*before, open_row if open_row >= 0 else None, True)])

    return rows.select(*COMPARED_NAMES).mapInArrow(lean(run), f"{COMPARED}, more int, edge boolean")


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``id``, ``row`` and ``spans`` (first byte, byte after the last; they may touch
    or overlap) of texts (id, row, text) in which a string of ``length`` bytes starts
    that also starts elsewhere in the table."""
    # texts are parsed twice: the parse of all of them would be larger than they are
    cores = written(parsed(rows, length, True).groupBy("core").agg(F.count("*").alias("times")).where("times > 1"))
    live = written(kept(parsed(rows, length), cores, "core", *ENTRY))
    discard(cores)
    # "first" takes all columns of an entry from one and the same row
    entry = [F.first(c).alias(c) for c in ("core", "head", *ENTRY)]
    places = F.sum(1 + F.coalesce(F.array_size("more"), F.lit(0)))
    dictionary = written(live.groupBy("full", "full2").agg(places.alias("times"), F.count("*").alias("texts"), *entry))
    sure = matched(live, dictionary.where("times > 1").select("full", "full2", F.col("texts").alias("times")), ["full", "full2"])
    each = F.concat(F.array("at"), F.coalesce("more", F.expr("cast(array() as array<long>)")))
    sure = written(sure.select(*ID, F.transform(each, lambda at: F.struct(first_window(at).alias("lo"), (last_window(at) + length).alias("end"))).alias("spans")))
    discard(live)

    kinds = dictionary.groupBy("core").agg(F.count("*").alias("entries"), F.count_if(F.col("times") == 1).alias("lone"), (F.min("head") != F.max("head")).alias("mixed"))
    kinds = written(kinds.where("entries > 1 AND lone > 0").select("core", "mixed", F.col("entries").alias("times")))
    doubtful = matched(dictionary.withColumn("lone", F.col("times") == 1).drop("times"), kinds, ["core"], "inner").select(*ID, first_window(F.col("at")).alias("lo"), last_window(F.col("at")).alias("hi"), "lone", "mixed")
    both = written(compared(rows, doubtful, length))
    discard(dictionary, kinds)
    begun = both.where("tail IS NOT NULL")
    # only where another entry begins with the same window
    heads = written(begun.groupBy("a", "b").agg(F.count("*").alias("times"), F.count_if("lone").alias("open")).where("times > 1 AND open > 0").select("a", "b", "times"))
    by = ("a", "b", "tail", *ID, "lo")
    order = matched(begun, heads, ["a", "b"]).repartitionByRange(*by).sortWithinPartitions(*by)
    order = written(neighbours_in_order(order))
    edges = neighbours_in_order(order.where("edge").coalesce(1).sortWithinPartitions(*by))  # two rows a partition
    told = (*ID, "lo", "lone", "more")
    follow = order.select(*told).unionByName(edges.select(*told)).where("lone AND more IS NOT NULL")
    follow = follow.select(*ID, "lo", (F.col("lo") + F.col("more") + length).alias("end"))

    inside = both.where("tail IS NULL")
    twice = written(inside.groupBy("a", "b").agg(F.count("*").alias("times"), F.count_if("lone").alias("open")).where("times > 1 AND open > 0").select("a", "b"))
    within = written(inside.where("lone").join(twice, ["a", "b"], "left_semi").select(*ID, "lo", (F.col("lo") + length).alias("end")))
    discard(both, heads, twice)
    single = follow.unionByName(within).select(*ID, F.array(F.struct("lo", "end")).alias("spans"))
    out = written(sure.unionByName(single).groupBy(*ID).agg(F.flatten(F.collect_list("spans")).alias("spans")))
    discard(sure, order, within)
    return out


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that spans cover."""
    out: list[tuple[int, int]] = []
    for lo, end in sorted((s["lo"], s["end"]) for s in spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((lo, end))
    return out


def identity(key: str, text: str) -> tuple[Column, Column]:
    """``id`` and ``row`` of a row; neither is null."""
    row = F.xxhash64(text)
    return F.coalesce(F.col(key).cast("long"), row).alias("id"), row.alias("row")


def remove_repeats(docs: DataFrame, length: int = LENGTH, key: str = "doc_id", keep: tuple[str, ...] = (), also: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``key``, the columns ``keep``, ``n_bytes``, ``removed`` (maximal runs of
    removed bytes: start, end), ``kept`` (binary: the rest, concatenated) and
    ``text`` (the rest as text, without characters of which a part is removed).

    Removed is each byte of a text's UTF-8 that a string of ``length`` bytes
    covers which also starts anywhere else, the same text included; matches
    never cross texts, and strings are judged on the input. So all copies go.
    ``also`` finds more spans to remove in the same texts (as ``repeated_spans`` does).

    Null or empty texts, and those shorter than ``length``, lose nothing.
    Repeated rows are copies of each other. Rows are told apart by key (null,
    too) and text, so unlike texts that share a key are judged each. An empty
    table gives an empty one. Other columns are ignored.
    """
    rows = texts(docs, key).select(*identity(key, "text"), "text")
    spans = repeated_spans(rows, length)
    if also is not None:
        spans = written(spans.unionByName(also(rows)).groupBy(*ID).agg(F.flatten(F.collect_list("spans")).alias("spans")))
    whole = docs.select(key, *(c for c in keep if c not in (key, "text")), F.coalesce("text", F.lit("")).alias("_text"))
    names = [c for c in whole.columns if c != "_text"]
    whole = whole.select("*", *(c.alias(f"_{n}") for c, n in zip(identity(key, "_text"), ID, strict=True)))
    spans = spans.withColumnsRenamed({c: f"_at_{c}" for c in ID})
    ids = sized(spans.drop("spans"))
    same = (F.col("_id") == F.col("_at_id")) & (F.col("_row") == F.col("_at_row"))
    clean = whole.join(ids, same, "left_anti")
    runs = "array<struct<start:long,end:long>>"
    clean = clean.select(*names, F.octet_length("_text").cast("long").alias("n_bytes"), F.expr(f"cast(array() as {runs})").alias("removed"), F.encode("_text", "UTF-8").alias("kept"), F.col("_text").alias("text"))
    hit = whole.join(ids, same, "left_semi").join(spans, same).select(*names, "_text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            kept, sizes, gone = [], [], []
            for text, found in zip(b.column("_text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                raw, at, parts, runs_of = text.encode(), 0, [], merged(found)
                for lo, end in runs_of:
                    parts.append(raw[at:lo])
                    at = end
                kept.append(b"".join([*parts, raw[at:]])), sizes.append(len(raw)), gone.append([{"start": x, "end": y} for x, y in runs_of])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(sizes, pa.int64()), pa.array(gone, kind), pa.array(kept, pa.binary()), pa.array([k.decode(errors="ignore") for k in kept], pa.string())], names=[*names, "n_bytes", "removed", "kept", "text"])

    return clean.unionByName(hit.mapInArrow(lean(run), clean.schema))
