"""Packing along a space-filling curve.

Each document's tokens are hashed into a vector, the vector is projected to few
dimensions and those to a key on a Hilbert curve. Documents are range-partitioned
and sorted by that key, and what lies next to each other on the curve is packed
into sequences. A document is cut where a sequence is full.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_count import byte_symbols
from .common import held, lean, slices, texts, tokenizer_path, written

HASHED, DIMENSIONS, BITS = 1024, 4, 15
#: Bits of the key by which the curve's cells are weighed: so many of them at most that the driver deals out.
CELL_BITS = 14
#: Tasks at most; beyond it they grow, as each only streams what it sorted.
MOST_TASKS = 50_000
#: Chunks, and words without marks and capitals, of which a worker keeps the identifiers.
KEPT, KEPT_WORDS = 120_000, 350_000
#: Characters at which str.split cuts, but which are no white space to the tokenizer.
ODD = "\x1c\x1d\x1e\x1f"


#: What a chunk may end in and still share the identifiers of its word.
MARKS = ".,!?;:"


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit numbers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Chunks(dict):
    """Identifiers, as little-endian unsigned 32-bit numbers, of what stands
    between white space. The tokenizer drops white space and no token goes
    across it, so a text's identifiers are those of its chunks. It also cuts
    letters from marks and lower-cases, so "Word," has those of "word" and ","."""

    def __init__(self, name: str, kept: int = KEPT, words: int = KEPT_WORDS):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most, self.most_words = Tokenizer.from_file(tokenizer_path(name)), kept, words
        self.words: dict[str, bytes] = {}
        self.model, self.byte = self.tokenizer.model, byte_symbols()

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def word(self, word: str, letters: bool) -> bytes:
        """``letters``: lower-case Latin ones only, which the tokenizer hands to its model as one piece."""
        ids = self.words.get(word)
        if ids is None:
            if letters:
                shown = word if word.isascii() else "".join([self.byte[b] for b in word.encode()])
                ids = packed([t.id for t in self.model.tokenize(shown)])
            else:
                ids = self.whole(word)
            if len(self.words) >= self.most_words:
                self.words.clear()
            if len(word) < 60:
                self.words[word] = ids
        return ids

    def __missing__(self, chunk: str) -> bytes:
        word = chunk.rstrip(MARKS)
        folded = word.lower()
        if folded.isalpha() and max(word) < "\u0250":
            ids = self.word(folded, True)
            if len(word) < len(chunk):
                ids += self.word(chunk[len(word) :], False)
        else:
            ids = self.word(chunk, False)
        if len(self) >= self.most:
            self.clear()
        if len(chunk) < 60:
            self[chunk] = ids
        return ids

    def text(self, text: str) -> bytes:
        if any(map(text.__contains__, ODD)):
            return self.whole(text)
        return b"".join(map(self.__getitem__, text.split()))


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of unsigned coordinates below
    2 ** bits (Skilling's transposed form, for all rows at once)."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    for b in range(bits - 1, 0, -1):
        q, p = 1 << b, (1 << b) - 1
        for i in range(n):
            inverted = (x[i] & q) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(inverted, p, swapped)
            x[i] ^= swapped
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        t ^= np.where(x[n - 1] & (1 << b), (1 << b) - 1, 0)
    x ^= t
    key = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | x[i] >> b & 1
    return key


def curve_keys(ids: list[bytes], seed: int = 7) -> np.ndarray:
    """The curve's key of each document, from the hashed square-root counts of its tokens."""
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (HASHED, DIMENSIONS))
    at = np.zeros((len(ids), DIMENSIONS))
    for k in range(0, len(ids), 64):  # so many rows of counts as stay in a core's cache
        some = ids[k : k + 64]
        hashed = ((np.frombuffer(b"".join(some), "<u4") * np.uint32(2654435761)) >> np.uint32(22)).astype(np.int64)
        hashed += np.repeat(np.arange(len(some)) * HASHED, [len(x) // 4 for x in some])
        v = np.sqrt(np.bincount(hashed, minlength=len(some) * HASHED)).reshape(len(some), HASHED)
        at[k : k + 64] = (v @ signs) / np.maximum(np.sqrt((v**2).sum(1)), 1)[:, None]
    side = 1 << BITS
    return hilbert(np.clip((at / 8 + 0.5) * side, 0, side - 1).astype(np.int64), BITS)


def tokenized(docs: DataFrame, tokenizer: str, end_id: int, key: str) -> DataFrame:
    """``key``, ``curve``, ``n`` and ``ids`` (with the end's) of each document."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = held(Chunks, tokenizer)
        for b in slices(batches):
            ids = [chunks.text(t) for t in b.column("text").to_pylist()]
            keys = pa.array(curve_keys(ids), pa.int64())
            ids = [x + end for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(key), keys, pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], names=[key, "curve", "n", "ids"])

    rows = texts(docs, key)
    return rows.mapInArrow(lean(run, keeps=True), f"`{key}` {rows.schema[key].dataType.simpleString()}, curve long, n long, ids binary")


def cuts(length: int) -> list[int]:
    """The last tokens of a partition in full powers of two, largest first."""
    return [1 << b for b in range(length.bit_length() - 1, -1, -1) if length >> b & 1]


def dealt(found: DataFrame, tasks: int, tokens_per_task: int) -> DataFrame:
    """``found`` in partitions of about as many tokens each, which follow each
    other on the curve. Weighed are cells of the curve; what is in a cell that is
    too much for a task is dealt to several, row by row."""
    cell = F.shiftright("curve", DIMENSIONS * BITS - CELL_BITS)
    weights = sorted((r["cell"], r["n"]) for r in found.groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).collect())  # 2 ** CELL_BITS rows at most
    total = sum(n for _, n in weights)
    most = max(1, min(tokens_per_task, math.ceil(total / tasks)), math.ceil(total / MOST_TASKS))
    rows, part, used = [], 0, 0
    for at, n in weights:
        if used and used + n > most:
            part, used = part + 1, 0
        slices_ = math.ceil(n / most)
        rows.append((at, part, slices_))
        part, used = (part + slices_, 0) if slices_ > 1 else (part, used + n)
    places = found.sparkSession.createDataFrame(rows, "cell long, first int, slices int")
    placed = found.withColumn("cell", cell).join(F.broadcast(places), "cell")
    placed = placed.withColumn("part", (F.col("first") + F.floor(F.rand(7) * F.col("slices"))).cast("int"))
    return placed.drop("cell", "first", "slices").repartitionById(part + 1, "part")


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, length: int = 4096, key: str = "doc_id", tokens_per_task: int = 4_000_000) -> DataFrame:
    """Pieces of documents, and the sequence and offset that each has.

    Columns: ``key``, ``start``, ``length``, ``ids`` (binary, little-endian
    unsigned 32-bit), ``doc_tokens``, ``sequence_id``, ``offset``. ``length``
    is a power of two. Each range of the curve fills sequences of ``length``
    tokens; what is left at its end goes into sequences that are powers of two,
    so that none is padded. Sequence ids are unique, not gapless.

    A null or empty text is the end's identifier alone. Repeated rows and equal
    texts are packed each (ties on the curve: by key). An empty table gives an
    empty one. A null key is kept. Other columns are ignored.
    """
    found = written(tokenized(docs, tokenizer, end_id, key))
    kind = found.schema[key].dataType.simpleString()
    ordered = dealt(found, docs.sparkSession.sparkContext.defaultParallelism, tokens_per_task).sortWithinPartitions("curve", key, "n", "ids")
    ordered = ordered.withColumn("part", F.col("part").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        done: list[tuple] = []  # pieces of full sequences
        waiting: list[tuple] = []  # pieces of the open one: key, start, ids, doc_tokens
        used = count = base = 0

        def close(sizes: list[int]) -> None:
            nonlocal count, waiting
            pieces = iter(waiting)
            doc, start, ids, n = next(pieces, (None, 0, b"", 0))
            for size in sizes:
                offset = 0
                while offset < size:
                    took = min(size - offset, len(ids) // 4)
                    if took:
                        done.append((doc, start, took, ids[: 4 * took], n, base + count, offset))
                    offset, start, ids = offset + took, start + took, ids[4 * took :]
                    if not ids:
                        doc, start, ids, n = next(pieces, (None, 0, b"", 0))
                count += 1
            waiting = []

        def out() -> pa.RecordBatch:
            cols = list(zip(*done, strict=True))
            done.clear()
            kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

        key_type = pa.int64()
        for b in batches:
            key_type = b.schema.field(key).type
            if b.num_rows:
                base = b.column("part")[0].as_py() << 40
            for doc, ids in zip(b.column(key).to_pylist(), b.column("ids"), strict=True):
                ids = ids.as_py()
                n, start = len(ids) // 4, 0
                while start < n:
                    took = min(length - used, n - start)
                    waiting.append((doc, start, ids[4 * start : 4 * (start + took)], n))
                    used, start = used + took, start + took
                    if used == length:
                        close([length])
                        used = 0
                    if len(done) >= 2000:
                        yield out()
            if done:
                yield out()
        if used:
            close(cuts(used))
        if done:
            yield out()

    return ordered.select(key, "ids", "part").mapInArrow(lean(run), f"`{key}` {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
