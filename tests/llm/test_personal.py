"""Personal data: base spans against plain patterns, what is added, and the estimates."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from tallytree.llm import personal_data as pd_
from tallytree.llm import queries

SCHEMA = "doc_id long, text string, spans string, kind int"
#: The contract's patterns as they stand.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or "", re.ASCII):
            d = re.sub("[^0-9]", "", m.group())
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else 0, "card": 13 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def noise(rng):
    pieces = ["1.2.3.4", "300.1.2.3", "1.2.3.4.5.6.7.8", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (407) 555-7710", "+49 30 901820", "++1234567890", "+1(", "a@b.c", "x.y+z@mail.example.com", "@a.b", "a@@b.c", "a@b", "a@b.c@d.e", "q@-.-", "é@é.com", "12", "7", ".", " ", "-", "É", "word", "\n", "٣٤", "0.0.0.0", "1..2.3.4", "0004.5.6.7", "5105105105105100 10.0.0.1"]
    return "".join(rng.choice(pieces) + rng.choice(["", " ", " ", "x"]) for _ in range(rng.randint(0, 14)))


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    for _ in range(4000):
        text = noise(rng)
        assert [f"{k}:{a}:{b}" for k, found in zip(pd_.KINDS, pd_.base_spans(text), strict=True) for a, b in found] == plain(text), text


def test_base_spans_stay_and_hidden_ones_are_added(spark, tmp_path):
    rng = random.Random(2)
    say = lambda n: " ".join(rng.choice("the of river stone walks under light green".split()) for _ in range(n))
    planted = ["anna.b@mail3.example.com", "+1 (407) 555-7710", "4539578763621486", "85.134.245.158"]
    clean = ["order 1234567890123456 came", "version 12.4.0.1 of it", "id 4539578763621487", "token = \"9742a250774262d69ad6a86100194ed53da5a0e\"", "in 1998 and 2004, 17 of 300", "isbn 9783161484100 here", "sum 1 000 000 000 000"]
    texts = [f"{say(20)} {planted[i % 4]} {say(20)}" for i in range(200)] + [f"{say(20)} {clean[i % len(clean)]} {say(9)}" for i in range(140)]
    glued = f"{say(4)} +1 (578) 555-6437 4539578763621486 {say(3)}"
    two = f"{say(4)} 4539578763621486 4716108999716531 {say(3)}"
    hidden = f"{say(2)} mail anna (at) mail3.example.com {say(2)}"
    next_to_ip = f"{say(4)} +1 (826) 555-4081 190.137.223.204 {say(3)}"
    texts += [glued, two, hidden, next_to_ip, None, "", " ", "9" * 50_000, "a" * 50_000 + "@", texts[0], texts[1] * 3000]
    rows = [(i, t, "x", 7) for i, t in enumerate(texts)] + [(None, texts[2], "x", 7), (5, texts[5], "x", 7)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op13_personal_data(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    sha = lambda xs: hashlib.sha256(",".join(xs).encode()).hexdigest()
    for r in got:
        base = plain(texts[r["doc_id"]] if r["doc_id"] is not None else texts[2])
        assert r["base_sha256"] == sha(base)
        assert [r[f"n_{k}"] for k in pd_.KINDS] == [sum(x.startswith(k) for x in base) for k in pd_.KINDS]
        assert set(base) <= set(r["spans"].split(",")) | ({""} if not base else set())
        if r["doc_id"] is not None and 200 <= r["doc_id"] < 340:
            assert r["spans"] == ",".join(base), texts[r["doc_id"]]
    spans = {r["doc_id"]: r["spans"].split(",") for r in got}
    at = lambda kind, text, s: f"{kind}:{text.index(s)}:{text.index(s) + len(s)}"
    assert spans[340] == [at("card", glued, "4539578763621486"), at("phone", glued, "+1 (578) 555-6437")]
    assert spans[341] == [at("card", two, "4539578763621486"), at("card", two, "4716108999716531")]
    assert spans[342] == [at("email", hidden, "anna (at) mail3.example.com")]
    assert spans[343] == [at("ip", next_to_ip, "190.137.223.204"), at("phone", next_to_ip, "+1 (826) 555-4081")]
    assert queries.op13_personal_data(spark, str(tmp_path)).limit(0).count() == 0


def test_an_empty_table_and_one_without_candidates(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert pd_.personal_data(none).count() == 0
    calm = spark.createDataFrame([(1, "calm", "x", 1), (None, None, "x", 1)], SCHEMA)
    assert [r["spans"] for r in pd_.personal_data(calm).collect()] == [[], []]


@pytest.mark.parametrize("text", ["9" * 400_000, "a" * 400_000, "1.2." * 100_000, "+1+1" * 100_000, "a@" * 200_000, "4 " * 200_000, "4444 4444 4444 4444 " * 20_000, "+1 (407) 555-7710 " * 20_000])
def test_long_texts_take_time_in_proportion(text):
    began = time.time()
    pd_.candidates(text)
    assert time.time() - began < 20


def test_reliabilities_are_those_that_made_the_votes():
    rng = np.random.default_rng(5)
    right = np.array([0.95, 0.9, 0.75, 0.6, 0.85, 0.9])
    y = rng.random(20_000) < 0.4
    votes = np.where(rng.random((20_000, 6)) < right, y[:, None], ~y[:, None]).astype(int)
    votes[rng.random(votes.shape) < 0.2] = 2
    kinds = np.full(len(y), 2)
    same, at, n = np.unique(np.column_stack([kinds, votes]), axis=0, return_inverse=True, return_counts=True)
    told = pd_.reliabilities(same[:, 0], same[:, 1:], n)
    assert abs(told.prior[2] - y.mean()) < 0.02
    assert np.abs(told.table[2, :, 1, 1] - right).max() < 0.03
    post = told.posterior(same[:, 0], same[:, 1:])[at.ravel()]
    assert ((post > 0.5) == y).mean() > 0.97
    shape = np.zeros(len(same), int)
    model = pd_.fit_classifier(same[:, 0], same[:, 1:], shape, n, told.posterior(same[:, 0], same[:, 1:]))
    assert ((model.scores(same[:, 0], same[:, 1:], shape)[at.ravel()] > 0.5) == (post > 0.5)).mean() > 0.98


def test_what_is_accepted_does_not_overlap():
    c = lambda kind, a, b, base=False, last="-": {"kind": kind, "start": a, "end": b, "base": base, "votes": "-----" + last, "shape": 0}
    found = [c(0, 0, 5, True), c(2, 10, 20), c(2, 15, 25), c(3, 24, 30), c(1, 40, 45), c(2, 3, 9, last="0"), c(3, 20, 24), c(1, 5, 10)]
    got = pd_.accepted(found, np.array([0.1, 0.8, 0.9, 0.7, 0.4, 0.99, 0.6, 0.6]), 0.5)
    assert [(x["kind"], x["start"]) for x in got] == [(0, 0), (1, 5), (2, 15)]
