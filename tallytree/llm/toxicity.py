"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a score from its hashed
words, the document's score is their noisy-or (toxic if any sentence is), and
the weights are learned from document labels alone. The sentences' own scores
then say which of them offend.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import steps, texts, written
from .quality import labelled
from .wordhash import LETTERS, byte_set, span_hashes, sums, word_spans

#: Bytes that end a sentence.
STOPS = byte_set(ord("."), ord("!"), ord("?"), 0x0A, 0x0D)
#: Bytes of the beginnings of longer words that count beside the words, so that
#: inflected forms share what is learned.
STEMS = (4, 5, 6, 7, 8)
SIEVE = 20  # bits of the table that tells most words apart from the lexicon's


def sentence_words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each text: sentences (first byte, byte after, text), and of each word
    its hash, lower-cased, and its sentence; the beginnings of long words follow
    as words of the same sentence."""
    first, after, text = word_spans(raw, off, ~STOPS)
    start, end, _ = word_spans(raw, off, LETTERS)
    running, sentence = sums(raw, lower=True), np.searchsorted(first, start, "right") - 1
    longer = [np.flatnonzero(end - start > n) for n in STEMS]
    stems = [span_hashes(running, start[i], start[i] + n) for n, i in zip(STEMS, longer, strict=True)]
    return first, after, text, np.concatenate([span_hashes(running, start, end), *stems]), np.concatenate([sentence, *(sentence[i] for i in longer)])


@dataclass
class Lexicon:
    """Sorted hashes of words with a weight, and every sentence's bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float
    sieve: np.ndarray

    def places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are words of the lexicon, and the place there."""
        hit = np.flatnonzero(self.sieve[h >> np.uint64(64 - SIEVE)])
        at = np.minimum(np.searchsorted(self.words, h[hit]), max(len(self.words) - 1, 0))
        same = self.words[at] == h[hit] if len(self.words) else np.zeros(0, bool)
        return hit[same], at[same]

    def sentences(self, h: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
        """Each sentence's score."""
        z = np.full(n, self.bias)
        hit, at = self.places(h)
        np.add.at(z, sentence[hit], self.weights[at])
        return 1 / (1 + np.exp(-z))


def lexicon(words: np.ndarray, weights: np.ndarray, bias: float) -> Lexicon:
    sieve = np.zeros(1 << SIEVE, bool)
    sieve[words >> np.uint64(64 - SIEVE)] = True
    return Lexicon(words, weights, bias, sieve)


def noisy_or(p: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(np.bincount(text, np.log1p(-np.minimum(p, 1 - 1e-12)), n))


def distinct_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of both without repeats, by the first and then the second."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each word of labelled texts: how many texts have it, and how many of
    those are toxic; summed over the texts of a step."""
    for b in batches:
        y = b.column("y").to_numpy()
        for at, to, raw, off in steps(b.column("text")):
            _, _, text, h, sentence = sentence_words(raw, off)
            h, doc = distinct_pairs(h, text[sentence] if len(sentence) else sentence)
            word, place = np.unique(h, return_inverse=True)
            bad = np.bincount(place, y[at:to][doc], len(word))
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(bad.astype(np.int64)), pa.array(np.bincount(place, minlength=len(word)))], names=["h", "bad", "n"])


def told_apart(rows: DataFrame, bad: int, good: int, most: int) -> np.ndarray:
    """The ``most`` words whose texts' labels differ most from the others', by
    the likelihood ratio, on either side; words of fewer than 3 texts don't count."""
    counts = rows.mapInArrow(word_counts, "h long, bad long, n long").groupBy("h").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).where("n >= 3")
    p, q, m = (F.col("bad") + 0.5) / (bad + 1), (F.col("n") - F.col("bad") + 0.5) / (good + 1), (F.col("n") + 1) / (bad + good + 2)
    ratio = F.col("bad") * F.log(p / m) + (F.col("n") - F.col("bad")) * F.log(q / m)
    counts = written(counts.select("h", ratio.alias("ratio"), (p > q).alias("side")).where("ratio > 3"))
    best = [counts.where(F.col("side") == side).orderBy(F.desc("ratio"), "h").limit(most).select("h").toArrow().column("h").to_numpy() for side in (True, False)]
    return np.sort(np.concatenate(best).astype(np.int64).view(np.uint64))


def train(words: np.ndarray, at: np.ndarray, sentence: np.ndarray, text: np.ndarray, sizes: np.ndarray, y: np.ndarray, rounds: int = 300, l1: float = 0.3, rate: float = 0.1) -> Lexicon:
    """Fits bias and weights of ``words`` to labels ``y`` of texts of ``sizes``
    sentences: place ``at`` in words, ``sentence`` and ``text`` of each
    occurrence. Adam over all rows at once, on the likelihood of the noisy-or
    with a penalty on the weights' size."""
    n = len(y)
    # only sentences with a known word differ from the others of their text
    order = np.lexsort((sentence, text))
    at, sentence, text = at[order], sentence[order], text[order]
    new = np.ones(len(at), bool)
    new[1:] = (text[1:] != text[:-1]) | (sentence[1:] != sentence[:-1])
    row, owner = np.cumsum(new) - 1, text[new]
    plain = sizes - np.bincount(owner, minlength=n)
    w, mean, square = (np.zeros(len(words) + 1) for _ in range(3))
    w[-1] = np.log(y.mean() / max(1.0, sizes.mean()))
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-(w[-1] + np.bincount(row, w[at], len(owner)))))
        p0 = 1 / (1 + np.exp(-w[-1]))
        none = np.exp(np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), n) + plain * np.log1p(-p0))
        pull = np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0)
        dz = pull[owner] * p
        grad = np.append(np.bincount(at, dz[row], len(words)) + l1 * np.sign(w[:-1]), dz.sum() + (pull * plain).sum() * p0)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    some = np.abs(w[:-1]) > 0.1
    return lexicon(words[some], w[:-1][some], float(w[-1]))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = 20_000, most_words: int = 1000, key: str = "doc_id") -> Lexicon:
    """Learns from ``label`` of at most ``most`` labelled rows, one a key, none
    held out (null labels and keys left out, null texts empty), weights of at most ``most_words`` words for and as many against.
    No such rows, or one class only: a constant score for every sentence."""
    rows = written(labelled(docs, labels, label, most, key))
    bad, n = rows.agg(F.coalesce(F.sum("y"), F.lit(0)), F.count("*")).first()
    if bad in (0, n):
        share = (bad + 0.5) / (n + 1)
        return lexicon(np.zeros(0, np.uint64), np.zeros(0), float(np.log(share / (1 - share))))
    known = lexicon(told_apart(rows, bad, n - bad, most_words), np.zeros(0), 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, sizes = [], []
            for _, _, raw, off in steps(b.column("text")):
                first, _, text, h, sentence = sentence_words(raw, off)
                hit, at = known.places(h)
                of = text[sentence[hit]] if len(hit) else hit
                sizes += np.bincount(text, minlength=len(off) - 1).tolist()
                found += [np.stack([at[of == d], sentence[hit][of == d]]).astype(np.int32).tobytes() for d in range(len(off) - 1)]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("y"), pa.array(found, pa.binary()), pa.array(sizes, pa.int32())], names=["k", "y", "hits", "sentences"])

    got = rows.mapInArrow(run, f"k {rows.schema[key].dataType.simpleString()}, y int, hits binary, sentences int").toArrow().sort_by([("k", "ascending"), ("hits", "ascending")])
    hits = [np.frombuffer(x, np.int32).reshape(2, -1) for x in got.column("hits").to_pylist()]
    text = np.repeat(np.arange(len(hits)), [x.shape[1] for x in hits])
    both = np.concatenate(hits, 1).astype(np.int64)
    return train(known.words, both[0], both[1], text, got.column("sentences").to_numpy(), got.column("y").to_numpy().astype(float))


def toxicity_scores(docs: DataFrame, model: Lexicon, offends: float = 0.5, key: str = "doc_id") -> DataFrame:
    """``key``, ``score`` of every whole text, and ``offending``: the sentences
    that score ``offends`` or more, as arrays of (start, end, score), in bytes
    of UTF-8.

    A null text counts as empty; a text without sentences scores 0; equal texts
    have equal scores; an empty table gives an empty one; other columns are
    ignored and a null key is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        for b in batches:
            scores, spans = [], []
            for _, _, raw, off in steps(b.column("text")):
                n = len(off) - 1
                first, after, text, h, sentence = sentence_words(raw, off)
                p = model.sentences(h, sentence, len(first))
                scores.append(noisy_or(p, text, n))
                mine: list[list[dict]] = [[] for _ in range(n)]
                for s in np.flatnonzero(p >= offends):
                    d = text[s]
                    mine[d].append({"start": int(first[s] - off[d]), "end": int(after[s] - off[d]), "score": float(p[s])})
                spans += mine
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(np.concatenate(scores) if scores else [], pa.float64()), pa.array(spans, kind)], names=[key, "score", "offending"])

    rows = texts(docs, key)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, score double, offending array<struct<start:long,end:long,score:double>>")
