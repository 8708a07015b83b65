"""Passages of many words that another text has, too, by winnowing.

``repeats`` judges byte strings of a fixed length; a passage of few or short words is
under it. Here words are counted and compared (white space ends them, of whichever
kind), and a passage is repeated where another text has it.

Each window of ``WORDS`` words is told by the gram of ``GRAM`` words in it with the
smallest hash, its core; equal windows have equal cores. Windows of a text in a row with the
same core at the same place are one phrase, which is judged as a whole: phrases whose
core no other text has are not repeated, phrases that another text has with all their
windows are. Only the others, where repeated passages begin and end, are compared
window by window, with one copy of each unlike phrase of their core.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_BYTES, discard, kept, lean, matched, mix, slices, steps, written
from .repeats import ID, WINDOWS, equal
from .wordhash import SPACED, powers, span_hashes, sums, word_spans

#: Over 50 words. Grams are short enough that few windows share none of their hashes' minima.
WORDS, GRAM = 51, 16
#: Bits of a word's number in a run of texts: a cell holds 2 GB at most.
PLACE = 30
#: A phrase's places in its text: first and last byte, first word, windows but one.
SPOTS = "spots array<struct<lo:int,end:int,word:int,wide:int>>"
PARSE = f"core long, full long, full2 long, id long, row long, word int, wide int, {SPOTS}"


def running(h: np.ndarray, which: int = 0) -> np.ndarray:
    """Running sums of words' hashes, for span_hashes."""
    out = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * powers(len(h) + 1, which)[0, : len(h)], out=out[1:])
    return out


def hashed(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, byte after the last, text and hash of each word."""
    start, end, doc = word_spans(raw, off, SPACED)
    return start, end, doc, span_hashes(sums(raw), start, end)


def sums_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return running(h), running(mix(h ^ np.uint64(0xD6E8FEB86659FD93)), 1)


def phrases(one: np.ndarray, doc: np.ndarray, words: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window, and core, of each phrase, as numbers of words."""
    grams = np.arange(len(doc) - gram + 1)
    low = np.uint64((1 << PLACE) - 1)
    least, have, want = span_hashes(one, grams, grams + gram) & ~low | grams.astype(np.uint64), 1, words - gram + 1
    while have < want:  # of equal hashes the first
        more = min(have, want - have)
        least, have = np.minimum(least[: len(least) - more], least[more:]), have + more
    at = np.flatnonzero(doc[: len(least)] == doc[words - 1 :])
    core = (least[at] & low).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (core[1:] != core[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    return at[first], at[np.append(first[1:], len(at)) - 1] if len(at) else at, core[first]


def parsed(rows: DataFrame, words: int, cores: bool = False) -> DataFrame:
    """A row for each unlike phrase of a text, with hashes of its core and of all its
    windows (128 bits), and its places; or the ``cores`` alone, once a text."""
    schema, gram = "core long" if cores else PARSE, min(GRAM, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            for at, to, raw, off in steps(b.column("text"), STEP_BYTES):
                start, end, doc, h = hashed(raw, off)
                if len(start) < words:
                    continue
                one, two = sums_of(h)
                lo, hi, place = phrases(one, doc, words, gram)
                of, core = doc[lo], span_hashes(one, place, place + gram)
                if cores:
                    first = np.unique(mix(core ^ mix(of.astype(np.uint64))), return_index=True)[1]
                    yield pa.RecordBatch.from_arrays([pa.array(core[first].view(np.int64))], names=["core"])
                    continue
                place = ((place - lo) * 1024 + (hi - lo)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                full = mix(span_hashes(one, lo, hi + words) + place), mix(span_hashes(two, lo, hi + words, 1) ^ place)
                first, by_run, counts = equal(of, *full)
                word = lo - np.searchsorted(doc, np.arange(to - at))[of]
                each = [x[by_run].astype(np.int32) for x in (start[lo] - off[of], end[hi + words - 1] - off[of], word, hi - lo)]
                spots = pa.StructArray.from_arrays([pa.array(x) for x in each], names=["lo", "end", "word", "wide"])
                upto = pa.array(np.append(0, np.cumsum(counts)).astype(np.int32))
                hashes = [pa.array(x[first].view(np.int64)) for x in (core, *full)]
                ids = [b.column(c).slice(at, to - at).take(pa.array(of[first])) for c in ID]
                ends = [pa.array(x[first].astype(np.int32)) for x in (word, hi - lo)]
                yield pa.RecordBatch.from_arrays([*hashes, *ids, *ends, pa.ListArray.from_arrays(upto, spots)], names=["core", "full", "full2", *ID, "word", "wide", "spots"])

    return rows.mapInArrow(lean(run), schema)


def windows(rows: DataFrame, entries: DataFrame, words: int) -> DataFrame:
    """A row for each window of phrases (id, row, word, wide, lone): its hash (a, b) and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 200):
            for at, to, raw, off in steps(b.column("text"), STEP_BYTES):
                start, end, doc, h = hashed(raw, off)
                one, two = sums_of(h)
                parts = b.column("entries").slice(at, to - at)
                flat, of = parts.flatten(), np.repeat(np.arange(to - at), parts.value_lengths().to_numpy(zero_copy_only=False))
                word, wide = (flat.field(f).to_numpy(zero_copy_only=False).astype(np.int64) for f in ("word", "wide"))
                word += np.searchsorted(doc, np.arange(to - at))[of]
                lone, upto, first = flat.field("lone").to_numpy(zero_copy_only=False).astype(bool), np.cumsum(wide + 1), 0
                while first < len(word):  # so many phrases at a time that their windows stay few
                    last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + WINDOWS, "right")))
                    n = wide[first:last] + 1
                    mine = np.repeat(np.arange(first, last), n)
                    lo = word[mine] + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    text = of[mine]
                    hashes = [pa.array(span_hashes(x, lo, lo + words, k).view(np.int64)) for k, x in enumerate((one, two))]
                    ids = [b.column(c).slice(at, to - at).take(pa.array(text)) for c in ID]
                    ends = [pa.array(x.astype(np.int32)) for x in (start[lo] - off[text], end[lo + words - 1] - off[text])]
                    yield pa.RecordBatch.from_arrays([*hashes, *ids, *ends, pa.array(lone[mine])], names=["a", "b", *ID, "lo", "end", "lone"])
                    first = last

    grouped = entries.groupBy(*ID).agg(F.collect_set(F.struct("word", "wide", "lone")).alias("entries"))
    return rows.join(grouped, list(ID)).select(*ID, "text", "entries").mapInArrow(lean(run), "a long, b long, id long, row long, lo int, end int, lone boolean")


def repeated_passages(rows: DataFrame, words: int = WORDS) -> DataFrame:
    """``id``, ``row`` and ``spans`` (first byte, byte after the last; they may touch or
    overlap) of texts (id, row, text) with ``words`` words in a row that another row
    has, too. Words are compared as they are, what stands between them isn't."""
    cores = written(parsed(rows, words, True).groupBy("core").agg(F.count("*").alias("times")).where("times > 1"))
    live = written(kept(parsed(rows, words), cores, "core", *ID, "word"))
    discard(cores)
    # "first" takes all columns of an entry from one and the same row
    entry = [F.first(c).alias(c) for c in ("core", *ID, "word", "wide")]
    dictionary = written(live.groupBy("full", "full2").agg(F.count("*").alias("times"), *entry))
    sure = matched(live, dictionary.where("times > 1").select("full", "full2", "times"), ["full", "full2"])
    sure = written(sure.select(*ID, F.transform("spots", lambda s: F.struct(s["lo"].alias("lo"), s["end"].alias("end"))).alias("spans")))

    kinds = dictionary.groupBy("core").agg(F.count("*").alias("entries"), F.count_if(F.col("times") == 1).alias("lone"))
    kinds = written(kinds.where("entries > 1 AND lone > 0").select("core", F.col("entries").alias("times")))
    doubtful = written(matched(dictionary.withColumn("lone", F.col("times") == 1).drop("times"), kinds, ["core"]))
    spots = live.join(doubtful.where("lone").select("full", "full2"), ["full", "full2"], "left_semi").select(*ID, F.explode("spots").alias("s"))
    spots = spots.select(*ID, "s.word", "s.wide", F.lit(True).alias("lone"))
    both = written(windows(rows, spots.unionByName(doubtful.where("NOT lone").select(*ID, "word", "wide", "lone")), words))
    discard(live, dictionary, kinds, doubtful)
    # a window of a phrase that others have is in two texts; others may be twice in one text
    text = F.xxhash64(*ID)
    twice = both.groupBy("a", "b").agg(F.count("*").alias("times"), F.count_if("lone").alias("open"), F.min(text).alias("least"), F.max(text).alias("most"))
    twice = written(twice.where("open > 0 AND (open < times OR least != most)").select("a", "b", "times"))
    within = written(matched(both.where("lone"), twice, ["a", "b"]).select(*ID, F.array(F.struct("lo", "end")).alias("spans")))
    discard(both, twice)
    out = written(sure.unionByName(within).groupBy(*ID).agg(F.flatten(F.collect_list("spans")).alias("spans")))
    discard(sure, within)
    return out
