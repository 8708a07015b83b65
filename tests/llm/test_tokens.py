"""Token counts and packing against the tokenizers themselves."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallytree.llm import bpe_count, packing
from tallytree.llm.common import tokenizer_path
from tallytree.llm.queries import op1_packing

ODD = ["a", "b", "é", " ", "  ", "\n", "\t", "1", "23", "'s", "'re", "!", "<|endoftext|>", "漢字", "\x1c", "\x85", "​", "　", "İ", "ß", "A", " the", "\r\n", "🙂", "é", "Σ", ",", "Word,"]
SCHEMA = "doc_id long, text string, ids int, curve string"


def odd_texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_counts_are_the_librarys():
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    count = bpe_count.Counter(tokenizer_path("byte_bpe_50k.json"), kept=50)
    for text in [*odd_texts(4000), "x" * 3000, "ab " * 2000]:
        assert count.text(text) == len(tokenizer.encode(text, add_special_tokens=False)), repr(text)


def test_identifiers_are_the_librarys():
    chunks = packing.Chunks("word_bpe_49k.json", kept=50, words=50)
    for text in [*odd_texts(4000, 2), "x" * 3000]:
        assert chunks.text(text) == np.array(chunks.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_counts_of_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(1, None, 0, "x"), (2, "", 0, "x"), (3, "a b", 0, "x"), (3, "a b", 0, "x"), (None, "é", 0, "x")], SCHEMA)
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in bpe_count.token_counts(docs).collect())
    assert got == [(0, 2, 1), (1, 0, 0), (2, 0, 0), (3, 3, 2), (3, 3, 2)]
    assert bpe_count.token_counts(docs.limit(0)).count() == 0


def test_hilbert_neighbours_touch():
    points = np.stack(np.meshgrid(np.arange(8), np.arange(8)), -1).reshape(-1, 2)
    keys = packing.hilbert(points, 3)
    assert sorted(keys) == list(range(64))
    steps = np.abs(np.diff(points[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()


@pytest.mark.parametrize("length", [8, 64])
def test_every_identifier_is_in_one_piece(spark, length):
    texts = [*odd_texts(60, 3), None, "", "w " * 300, "same text", "same text"]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in enumerate(texts)], SCHEMA)
    pieces = packing.pack(docs, length=length).collect()
    chunks = packing.Chunks("word_bpe_49k.json")
    of, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        of[p["doc_id"]].append(p)
        sequences[p["sequence_id"]].append(p)
    for i, text in enumerate(texts):
        mine = sorted(of[i], key=lambda p: p["start"])
        want = chunks.text(text or "") + (2).to_bytes(4, "little")
        assert b"".join(bytes(p["ids"]) for p in mine) == want
        assert [p["start"] for p in mine] == [sum(q["length"] for q in mine[:k]) for k in range(len(mine))]
        assert {p["doc_tokens"] for p in mine} == {len(want) // 4}
    for s in sequences.values():
        s.sort(key=lambda p: p["offset"])
        assert [p["offset"] for p in s] == [sum(q["length"] for q in s[:k]) for k in range(len(s))]
        total = sum(p["length"] for p in s)
        assert total <= length
        assert total & (total - 1) == 0
    assert packing.pack(docs.limit(0), length=length).count() == 0


def test_the_query_has_checksums(spark, tmp_path):
    spark.createDataFrame([(5, "hello", 0, "x")], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    (row, *more) = sorted(op1_packing(spark, str(tmp_path)).collect(), key=lambda r: r["start"])
    ids = packing.Chunks("word_bpe_49k.json").text("hello") + (2).to_bytes(4, "little")
    whole = [row, *more]
    assert [r["ids_crc32"] for r in whole] == [zlib.crc32(ids[4 * r["start"] : 4 * (r["start"] + r["length"])]) for r in whole]
