"""Personal data by weak supervision.

Base patterns find what they find, and stay. Beside them wider patterns propose
candidates: cards, numbers and addresses that stand next to other digits, where a base
pattern runs over its end and fails. Of each candidate several labelers say whether it
is personal data, or abstain: its strict form, its checksum or range, a gazetteer of
issuers, country codes and domains, the word before it, what it touches, and the base
pattern itself. Candidates are counted by their votes over the whole corpus, expectation
maximisation estimates from these counts how reliable each labeler is on either class,
and a classifier of spans, fitted to the posteriors of all candidates, decides. What it
accepts and no base span of its kind overlaps is added.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, texts, written

KINDS = ("email", "ip", "card", "phone")

#: The base patterns, email apart, which is searched from its ``@``. A run of
#: digits is tried from its start alone: from later digits it would end and fail alike.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

#: What every span of digits has inside; most texts have none.
NEAR = re.compile(r"[0-9][0-9 ().-]{6}")

#: What is proposed beside base spans.
PROPOSED = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|@) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,63}){1,4}(?![A-Za-z0-9-])"),
    "ip": re.compile(r"(?<![0-9])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])"),
    "card": re.compile(r"(?<![0-9])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}|[0-9]{13,19})(?![0-9])"),
    "phone": re.compile(r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\) ?[0-9]{3,4}[ .-][0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4})(?![0-9])"),
}
#: The strict form of each kind.
STRICT = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"),
    "ip": re.compile(r"(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})"),
    "card": re.compile(r"[0-9]{16}|[0-9]{15}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}"),
    "phone": re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{4}"),
}
#: The gazetteer. Beginnings of card numbers, country codes, ends of domains.
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "60", "62", "64", "65", "22", "23", "24", "25", "26", "27")
COUNTRIES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "64", "65", "81", "82", "86", "90", "91", "351", "353", "358", "380")
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "nl", "ch", "at", "eu", "us", "ca", "mx", "ar", "br", "pl", "ru", "jp", "cn", "in", "au", "example", "test")
#: Words before personal data, and before what only looks like it.
CUES = {
    "email": frozenset("email e-mail mail mailto contact correo courriel write".split()),
    "ip": frozenset("ip host address server client from".split()),
    "card": frozenset("card visa mastercard amex credit debit karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile fax telefon téléphone teléfono whatsapp".split()),
}
DENIED = frozenset("isbn issn version v order invoice item sku token id hash sha key serial part no nr section build release figure doi".split())
LABELERS = ("form", "checksum", "gazetteer", "context", "contact", "base")

#: What a text has if an email in another form is in it.
SPACED = ("(at)", "[at]", "@ ", " @", "(dot)", "[dot]")

CANDIDATE = "kind int, start int, end int, base boolean, votes string, shape int"
FOUND = f"array<struct<{CANDIDATE.replace(' int', ':int').replace(' boolean', ':boolean').replace(' string', ':string')}>>"


def luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return (sum(d[::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping ones; a run of local characters is walked once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCALS:
            start -= 1
        end = DOMAIN.match(text, at + 1) if start < at else None
        done = end.end() if end else at + 1
        if end:
            out.append((start, done))
        at = text.find("@", done)
    return out


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """The base spans of each kind, in order."""
    digits = lambda s: sum(c.isdigit() and c.isascii() for c in s)
    octets = lambda s: all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))
    if not NEAR.search(text):
        return [emails(text), [], [], []]
    ips = [m.span() for m in IP.finditer(text) if octets(m.group())]
    cards = [m.span() for m in CARD.finditer(text) if 13 <= m.end() - m.start() and 13 <= digits(m.group()) <= 19 and luhn(re.sub("[ -]", "", m.group()))]
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= digits(m.group()) <= 15]
    return [emails(text), ips, cards, phones]


def around(text: str, start: int, end: int) -> tuple[str, str, str]:
    """The word before a span, and the characters that it touches ('' at an end)."""
    before = re.search(r"([^\W\d_][\w-]*)\W{0,3}$", text[max(0, start - 24) : start])
    return (before.group(1).lower() if before else ""), text[start - 1 : start], text[end : end + 1]


def votes_of(kind: str, text: str, start: int, end: int, base: bool, clash: bool) -> str:
    """One character a labeler: 1 personal, 0 not, - abstains."""
    s = text[start:end]
    digits = "".join(c for c in s if "0" <= c <= "9")
    word, left, right = around(text, start, end)
    say = lambda yes, no: "1" if yes else "0" if no else "-"
    form = say(STRICT[kind].fullmatch(s), True)
    if kind == "card":
        check, known = say(luhn(digits), True), say(digits.startswith(ISSUERS), True)
    elif kind == "phone":
        check, known = say(9 <= len(digits) <= 15, not (s[0] == "(")), say(s[0] == "+" and digits.startswith(COUNTRIES), s[0] == "+")
    elif kind == "ip":
        parts = [int(p) for p in s.split(".")]
        check, known = say(max(parts) <= 255, True), say(False, parts[0] in (0, 127, 255) or max(parts) < 20)
    else:
        check, known = say("@" in s and ".." not in s, ".." in s), say(re.split(r"[.)\] ]+", s)[-1].lower() in DOMAINS, False)
    context = say(word in CUES[kind], word in DENIED)
    glue = lambda c: c.isalnum() or c in "_=/\\"
    touches = say(False, (bool(left) and glue(left)) or (bool(right) and glue(right))) if kind != "email" else "-"
    return form + check + known + context + touches + ("1" if base else "0" if clash else "-")


def shape_of(kind: str, text: str, start: int, end: int) -> int:
    """A span's form as a small number: digits (20 at most) and what it touches on either side."""
    _, left, right = around(text, start, end)
    side = lambda c: 0 if not c or c.isspace() else 1 if c in ".,;:!?)(\"'" else 2
    return min(20, sum("0" <= c <= "9" for c in text[start:end])) * 9 + side(left) * 3 + side(right)


def candidates(text: str) -> list[dict]:
    """The base spans and what is proposed beside them, with votes and shapes."""
    out, near = [], NEAR.search(text)
    for k, (kind, base) in enumerate(zip(KINDS, base_spans(text), strict=True)):
        spans = dict.fromkeys(base, True)
        if any(x in text for x in SPACED) if kind == "email" else near:
            for m in PROPOSED[kind].finditer(text):
                spans.setdefault(m.span(), False)
        at = 0
        for (start, end), own in sorted(spans.items()):
            while at < len(base) and base[at][1] <= start:
                at += 1
            clash = not own and at < len(base) and base[at][0] < end
            out.append({"kind": k, "start": start, "end": end, "base": own, "votes": votes_of(kind, text, start, end, own, clash), "shape": shape_of(kind, text, start, end)})
    return out


@dataclass
class Reliability:
    """Of each kind: the share of personal data, and of each labeler how often it votes
    0 and 1, where it votes, on either class (kind, labeler, class, vote)."""

    prior: np.ndarray
    table: np.ndarray

    def posterior(self, kind: np.ndarray, votes: np.ndarray) -> np.ndarray:
        """The chance that spans with these votes (a row each; 0, 1, 2 = abstains) are personal."""
        z = np.log(self.prior[kind]) - np.log(1 - self.prior[kind])
        for j in range(votes.shape[1]):
            said = np.minimum(votes[:, j], 1)
            z = z + np.where(votes[:, j] < 2, np.log(self.table[kind, j, 1, said]) - np.log(self.table[kind, j, 0, said]), 0)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def as_numbers(votes: list[str]) -> np.ndarray:
    return np.array([["01-".index(c) for c in v] for v in votes], np.int64).reshape(len(votes), len(LABELERS))


#: What is believed of each labeler before anything is counted: so many right votes, and wrong ones.
BELIEF = {"form": (6, 2), "checksum": (60, 1), "gazetteer": (6, 2), "context": (12, 1), "contact": (6, 2), "base": (60, 1)}


def reliabilities(kind: np.ndarray, votes: np.ndarray, n: np.ndarray, rounds: int = 100) -> Reliability:
    """Expectation maximisation over counted vote patterns (each is there once, with
    its count ``n``). Starts from what is believed of the labelers."""
    belief = np.array([[[a, b], [b, a]] for a, b in (BELIEF[x] for x in LABELERS)], float)
    out = Reliability(np.full(len(KINDS), 0.5), np.repeat((belief / belief.sum(2, keepdims=True))[None], len(KINDS), 0))
    post = out.posterior(kind, votes)
    for _ in range(rounds):
        for k in range(len(KINDS)):
            mine = kind == k
            mass = np.stack([(1 - post) * n, post * n])[:, mine]
            out.prior[k] = (mass[1].sum() + 1) / (mass.sum() + 2)
            for j in range(len(LABELERS)):
                for c in (0, 1):
                    count = np.bincount(votes[mine, j], mass[c], 3)[:2] + belief[j, c]
                    out.table[k, j, c] = count / count.sum()
        new = out.posterior(kind, votes)
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return out


def features(kind: np.ndarray, votes: np.ndarray, shape: np.ndarray) -> np.ndarray:
    """Of each span: kind, each labeler's vote within its kind, digits and both sides."""
    n, w = len(kind), len(LABELERS) * 2
    x = np.zeros((n, len(KINDS) * (1 + w + 21) + 6))
    rows = np.arange(n)
    x[rows, kind] = 1
    at = len(KINDS)
    for j in range(len(LABELERS)):
        some = votes[:, j] < 2
        x[rows[some], at + kind[some] * w + j * 2 + votes[some, j]] = 1
    at += len(KINDS) * w
    x[rows, at + kind * 21 + shape // 9] = 1
    at += len(KINDS) * 21
    x[rows, at + shape % 9 // 3] = 1
    x[rows, at + 3 + shape % 3] = 1
    return x


@dataclass
class Classifier:
    weights: np.ndarray

    def scores(self, kind: np.ndarray, votes: np.ndarray, shape: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features(kind, votes, shape) @ self.weights, -50, 50)))


def fit_classifier(kind: np.ndarray, votes: np.ndarray, shape: np.ndarray, n: np.ndarray, y: np.ndarray, rounds: int = 400, l2: float = 1e-3) -> Classifier:
    """Logistic regression on soft labels ``y`` of counted spans: Adam over all rows."""
    x = features(kind, votes, shape)
    share = n / max(n.sum(), 1)
    w, mean, square = (np.zeros(x.shape[1]) for _ in range(3))
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (share * (p - y)) + l2 * w / 100
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w -= 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return Classifier(w)


def proposed(docs: DataFrame, key: str) -> DataFrame:
    """``key`` and ``found``: the candidates of each whole text, as a table."""
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.string()), ("shape", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 200):
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array([candidates(t) for t in b.column("text").to_pylist()], kind)], names=[key, "found"])

    rows = texts(docs, key)
    return written(rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, found {FOUND}"))


def fit(found: DataFrame) -> tuple[Reliability, Classifier]:
    """Reliabilities and classifier of all candidates, which are counted by kind, votes
    and shape: both numbers of rows are bounded by the patterns that there can be."""
    each = found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.shape")
    counted = each.groupBy("kind", "votes", "shape").agg(F.count("*").alias("n")).orderBy("kind", "votes", "shape").toArrow()
    kind, shape, n = (counted.column(c).to_numpy().astype(np.int64) for c in ("kind", "shape", "n"))
    votes = as_numbers(counted.column("votes").to_pylist())
    same, at = np.unique(np.column_stack([kind, votes]), axis=0, return_inverse=True)
    at = at.ravel()
    told = reliabilities(same[:, 0], same[:, 1:], np.bincount(at, n, len(same)))
    return told, fit_classifier(kind, votes, shape, n, told.posterior(kind, votes))


def accepted(found: list[dict], scores: np.ndarray, least: float) -> list[dict]:
    """All base spans, and the candidates that score ``least`` or more and that no base
    span of their kind, and no better one added before, overlaps. In order of kind and start."""
    out = [dict(c, score=1.0) for c in found if c["base"]]
    more = sorted(((s, c) for s, c in zip(scores.tolist(), found, strict=True) if not c["base"] and s >= least and c["votes"][-1] != "0"), key=lambda x: (-x[0], x[1]["start"], x[1]["kind"]))
    ends: list[int] = []  # first and last place of each span that is taken, in order: none of them overlap
    for s, c in more:
        at = bisect.bisect_right(ends, c["start"])
        if at % 2 == 0 and (at == len(ends) or ends[at] >= c["end"]):
            ends[at:at] = [c["start"], c["end"]]
            out.append(dict(c, score=s))
    return sorted(out, key=lambda c: (c["kind"], c["start"]))


SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,score:double>>"


def personal_data(docs: DataFrame, key: str = "doc_id", least: float = 0.5) -> DataFrame:
    """``key`` and ``spans`` of each whole text, by kind and start: kind, start and end
    (code points, end exclusive), whether it is of the base patterns, and the score (1
    for base spans). Base spans are what they are however anything scores.

    Null and empty texts have no spans; equal texts have equal ones; long texts are
    searched in whole, in time linear in their length; null and repeated keys are kept;
    an empty table gives an empty one, and one without candidates has no spans. Other
    columns are ignored.
    """
    found = proposed(docs, key)
    _, model = fit(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())]))
        for b in slices(batches, 500):
            rows = b.column("found").to_pylist()
            flat = [c for r in rows for c in r]
            scores = model.scores(np.array([c["kind"] for c in flat], np.int64), as_numbers([c["votes"] for c in flat]), np.array([c["shape"] for c in flat], np.int64))
            out, at = [], 0
            for r in rows:
                out.append([{"kind": KINDS[c["kind"]], "start": c["start"], "end": c["end"], "base": c["base"], "score": c["score"]} for c in accepted(r, scores[at : at + len(r)], least)])
                at += len(r)
            yield pa.RecordBatch.from_arrays([b.column(key), pa.array(out, kind)], names=[key, "spans"])

    return found.mapInArrow(run, f"`{key}` {found.schema[key].dataType.simpleString()}, spans {SPANS}")
