"""Token counts by byte-pair merging with a heap over a linked list.

A text is cut as the tokenizer's own pattern cuts it; each piece starts as one
symbol a byte, the adjacent pair of lowest rank is popped from a heap and merged
until no pair has a rank. The count is the initial symbols less the merges; no
identifier is made. Counts of recurring chunks are kept in a bounded table.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, lean, slices, texts, tokenizer_path

#: White space as the tokenizer's pattern has it (Unicode's White_Space).
SPACE = r"\t-\r \x85\xa0  -     　"
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
#: Chunks of which a task keeps the count.
KEPT = 500_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (chr(256 + n) for n in range(256))
    shown = set(plain)
    return [chr(b) if b in shown else next(rest) for b in range(256)]


class Merges:
    """Ranks of pairs, from a tokenizer file of byte-level BPE."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: left << 20 | right -> rank << 20 | merged
        self.ranks = {vocab[a] << 20 | vocab[b]: rank << 20 | vocab[a + b] for rank, (a, b) in enumerate(pairs)}
        self.start = [vocab[c] for c in byte_symbols()]
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)  # the longest one counts

    def count(self, piece: bytes) -> int:
        """Symbols left when no adjacent pair has a rank."""
        get, symbol = self.ranks.get, [self.start[b] for b in piece]
        n = left = len(symbol)
        heap = [(r, i) for i in range(n - 1) if (r := get(symbol[i] << 20 | symbol[i + 1])) is not None]
        if not heap:
            return left
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            r, i = heappop(heap)
            j = after[i]
            if symbol[i] < 0 or j >= n or get(symbol[i] << 20 | symbol[j]) != r:
                continue  # one of the two has been merged since
            symbol[i], symbol[j] = r & 0xFFFFF, -1
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(symbol[i] << 20 | symbol[k])) is not None:
                    heappush(heap, (r, i))
            h = before[i]
            if h >= 0 and (r := get(symbol[h] << 20 | symbol[i])) is not None:
                heappush(heap, (r, h))
        return left


class Counter(dict):
    """Counts of chunks: what stands between single spaces, or starts a line.

    The pattern always cuts before a space or line end that stands alone
    between two characters that aren't white space, so a chunk's count doesn't
    hang on its neighbours. Texts with longer runs of white space are cut as a
    whole.
    """

    def __init__(self, path: str, kept: int = KEPT):
        super().__init__()
        self.merges, self.most = Merges(path), kept
        self.pieces = regex.compile(PIECE).findall
        self.runs = regex.compile(f"[{SPACE}][{SPACE}]").search
        self.special = regex.compile("|".join(map(regex.escape, self.merges.special))) if self.merges.special else None
        self.word = lru_cache(kept)(self.merges.count)

    def whole(self, text: str) -> int:
        return sum(self.word(p.encode()) for p in self.pieces(text))

    def __missing__(self, chunk: str) -> int:
        n = self.whole(chunk if chunk[:1] == "\n" else " " + chunk)
        if len(self) >= self.most:
            self.clear()
        if len(chunk) < 200:
            self[chunk] = n
        return n

    def plain(self, text: str) -> int:
        if self.runs(text):
            return self.whole(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.whole(first) + sum(map(self.__getitem__, rest))

    def text(self, text: str) -> int:
        """Tokens of a text, a special string inside it being one."""
        if self.special and self.special.search(text):
            parts = self.special.split(text)
            return len(parts) - 1 + sum(map(self.plain, parts))
        return self.plain(text)


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", key: str = "doc_id") -> DataFrame:
    """``key``, ``n_bytes`` and ``n_tokens`` of each text.

    A null or empty text has 0 bytes and 0 tokens; repeated rows are counted
    each; a null key is returned as it is; an empty table gives an empty one;
    other columns are ignored. ``tokenizer`` is a byte-level BPE file by name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = held(Counter, tokenizer_path(tokenizer))
        for b in slices(batches):
            found = b.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(key), pa.array([len(t.encode()) for t in found], pa.int64()), pa.array([count.text(t) for t in found], pa.int64())],
                names=[key, "n_bytes", "n_tokens"],
            )

    rows = texts(docs, key)
    return rows.mapInArrow(lean(run, keeps=True), f"`{key}` {rows.schema[key].dataType.simpleString()}, n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int) -> DataFrame:
    """Adds whether a text has more than ``limit`` tokens."""
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
