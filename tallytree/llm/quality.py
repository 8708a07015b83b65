"""Quality scores: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are counted with numpy for many texts at once. Trees
are fitted on binned statistics of a bounded sample of labelled rows, and kept
as arrays, through which all rows walk all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, modest_batches, mix, steps, texts
from .wordhash import SPACED, span_hashes, sums, word_spans

#: Classes of bytes whose shares are statistics.
CLASSES = [b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".", b",", b"!", b"?", b"|", b"$", b"%", b"&", b"*", b"#", b"@", b"<>", b"{}[]()", b"/\\", b":;", b"'\"`", b"-_=+~^"]
OTHER, HIGH = len(CLASSES), len(CLASSES) + 1
CLASS_OF = np.full(256, OTHER, np.int64)
for _k, _bytes in enumerate(CLASSES):
    CLASS_OF[list(_bytes)] = _k
CLASS_OF[128:] = HIGH
KINDS = HIGH + 1
#: Statistics after the classes' shares.
MORE = 13
WIDTH = KINDS + MORE


def repeats(doc: np.ndarray, h: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of distinct items, and of the commonest item, in each of n texts."""
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    first = np.ones(len(x), bool)
    first[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    at = np.flatnonzero(first)
    runs = np.diff(np.append(at, len(x)))
    total = np.maximum(np.bincount(doc, minlength=n), 1)
    most = np.zeros(n)
    np.maximum.at(most, d[at], runs)
    return np.bincount(d[at], minlength=n) / total, most / total


def statistics(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The statistics of each text, a row each; those of an empty text are 0."""
    n, size = len(off) - 1, np.diff(off)
    out = np.zeros((n, WIDTH))
    if not len(raw):
        return out
    text = np.repeat(np.arange(n), size)
    full = np.maximum(size, 1)
    out[:, :KINDS] = np.bincount(text * KINDS + CLASS_OF[raw], minlength=n * KINDS).reshape(n, KINDS) / full[:, None]
    start, end, doc = word_spans(raw, off, SPACED)
    running = sums(raw, lower=True)
    h, long = span_hashes(running, start, end), (end - start).astype(float)
    words = np.bincount(doc, minlength=n)
    some = np.maximum(words, 1)
    mean = np.bincount(doc, long, n) / some
    lines, line_end, line_doc = word_spans(raw, off, CLASS_OF != CLASS_OF[10])
    n_lines = np.maximum(np.bincount(line_doc, minlength=n), 1)
    upper = np.concatenate([[0], np.cumsum(CLASS_OF[raw] == 1)])
    letters = np.concatenate([[0], np.cumsum(CLASS_OF[raw] <= 1)])
    shouted = (upper[end] - upper[start] == letters[end] - letters[start]) & (long > 1) & (letters[end] > letters[start])
    last = CLASS_OF[raw[end - 1]]
    joined = mix(h[:-1]) * np.uint64(3) + h[1:]
    same = doc[:-1] == doc[1:]
    cols = [np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(np.bincount(doc, long**2, n) / some - mean**2, 0)), *repeats(doc, h, n), repeats(doc[:-1][same], joined[same], n)[0], np.bincount(doc, shouted, n) / some]
    cols += [np.bincount(doc, last > 6, n) / some, np.bincount(doc, letters[end] == letters[start], n) / some]
    cols += [np.log1p(np.bincount(line_doc, line_end - lines, n) / n_lines), *repeats(line_doc, span_hashes(running, lines, line_end), n)]
    out[:, KINDS:] = np.stack(cols, 1)
    out[size == 0] = 0
    return out


@dataclass
class Trees:
    """Complete trees, a row each: inner nodes in heap order, then leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.prior)
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None, :]
        if len(self.leaf):
            at = np.zeros((len(x), len(self.leaf)), np.int64)
            while at[0, 0] < self.feature.shape[1] if len(x) else False:
                at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
            out += self.leaf[trees, at - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-out))


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, l2: float = 2.0, least: float = 3.0) -> Trees:
    """Boosts logistic loss; every level splits all its nodes by histograms."""
    n, width = x.shape
    inner = (1 << depth) - 1
    share = y.mean() if n else 0.5
    prior = float(np.log((share * n + 0.5) / ((1 - share) * n + 0.5)))
    if n == 0 or share in (0.0, 1.0):
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), prior)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], 1)
    cut = np.full((width, bins), np.inf)
    for f in range(width):
        cut[f, : len(edges[f])] = edges[f]
    flat, z = binned + np.arange(width) * bins, np.full(n, prior)
    features, thresholds, leaves = [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        feature, threshold, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(n, np.int64)
        for level in range(depth):
            nodes = 1 << level
            cell = (node[:, None] * (width * bins) + flat).ravel()
            G = np.bincount(cell, np.repeat(g, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(2)
            H = np.bincount(cell, np.repeat(h, width), nodes * width * bins).reshape(nodes, width, bins).cumsum(2)
            g_all, h_all = G[:, :1, -1:], H[:, :1, -1:]
            gain = G**2 / (H + l2) + (g_all - G) ** 2 / (h_all - H + l2) - g_all**2 / (h_all + l2)
            gain[(H < least) | (h_all - H < least)] = 0
            best = gain.reshape(nodes, -1).argmax(1)
            f, b = best // bins, best % bins
            split = gain.reshape(nodes, -1).max(1) > 1e-6
            feature[nodes - 1 : 2 * nodes - 1] = f
            threshold[nodes - 1 : 2 * nodes - 1] = np.where(split, cut[f, b], np.inf)
            node = 2 * node + (x[np.arange(n), f[node]] > threshold[nodes - 1 + node])
        value = rate * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + l2)
        z += value[node]
        features.append(feature), thresholds.append(threshold), leaves.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), prior)


def held_out(key: str = "doc_id") -> F.Column:
    """Whether crc32 of the key as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int, key: str = "doc_id") -> DataFrame:
    """``key``, ``y`` (0 or 1) and ``text`` of at most ``most`` labelled keys that
    aren't held out: those that come first in an order by the key's hash. The keys
    are at most ``most`` and so may be broadcast. One row a key: of rows that share
    it the text that sorts first, of labels that differ the 1."""
    rows = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).select(key, F.col(label).cast("int").alias("y"))
    rows = rows.groupBy(key).agg(F.max("y").alias("y")).orderBy(F.xxhash64(key), key).limit(most)
    return texts(docs, key).join(F.broadcast(rows), key).groupBy(key, "y").agg(F.min("text").alias("text"))


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = 20_000, key: str = "doc_id") -> Trees:
    """Trees fitted to ``label`` on at most ``most`` labelled rows, one a key.

    Null labels and keys are left out; null texts count as empty.

    No such rows, or one class only: a constant score.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [statistics(raw, off) for _, _, raw, off in steps(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("y"), pa.array([r.tobytes() for x in found for r in x], pa.binary())], names=["k", "y", "x"])

    rows = labelled(docs, labels, label, most, key)
    got = rows.mapInArrow(lean(run), f"k {rows.schema[key].dataType.simpleString()}, y int, x binary").toArrow().to_pylist()
    got.sort(key=lambda r: (r["k"], r["x"]))
    x = np.frombuffer(b"".join(r["x"] for r in got)).reshape(-1, WIDTH)
    return fit_trees(x, np.array([r["y"] for r in got], float))


def quality_scores(docs: DataFrame, model: Trees, key: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns ``keep``, and ``score`` of every whole text.

    A null text counts as empty; an empty text has the score of statistics that
    are all 0; equal texts have equal scores; an empty table gives an empty one;
    other columns are ignored and a null key is kept.
    """
    modest_batches(docs.sparkSession)
    rows = texts(docs, key).select(key, "text") if not keep else docs.select(key, *(c for c in keep if c != key))
    at = "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            column = b.column(at)
            if column.null_count:
                column = column.fill_null("")
            scores = [model.scores(statistics(raw, off)) for _, _, raw, off in steps(column)]
            out = [c for c in b.schema.names if keep or c != at]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in out), pa.array(np.concatenate(scores) if scores else [], pa.float64())], names=[*out, "score"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    fields = [f for f in rows.schema if keep or f.name != at]
    return rows.mapInArrow(lean(run), StructType([*fields, StructField("score", DoubleType())]))
