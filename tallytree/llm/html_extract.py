"""Main text of web pages by a recurrent block labeller.

A page is the sequence of its leaf blocks. A bidirectional LSTM in numpy reads,
for each block, vectors of its tag path and of its hashed words, and labels it
as main text or not with the whole page as context. It is trained on pages made
by a seeded generator, whose blocks' labels are known.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import modest_batches
from .html_blocks import WIDTH, blocks, features

#: Containers of what isn't main text, and of main text (tag, names).
ASIDE = [("nav", ""), ("nav", "menu"), ("header", ""), ("header", "site-header"), ("footer", ""), ("footer", "site-footer"), ("aside", ""), ("aside", "sidebar"), ("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("div", "promo"), ("div", "banner"), ("div", "cookie"), ("div", "cookie-notice"), ("div", "consent"), ("div", "notice"), ("div", "gdpr"), ("div", "alert"), ("div", "popup"), ("div", "modal"), ("form", ""), ("form", "search"), ("form", "newsletter"), ("div", "subscribe"), ("div", "login"), ("div", "menu"), ("div", "navigation"), ("div", "navbar"), ("div", "breadcrumb"), ("div", "pagination"), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("div", "recommended"), ("div", "share"), ("div", "social"), ("div", "header"), ("div", "footer"), ("div", "copyright"), ("div", "comments"), ("section", "comments"), ("div", "comment"), ("ul", "comment-list"), ("ol", "comments"), ("div", "replies"), ("div", "disqus"), ("section", "reader-comments"), ("div", "toolbar"), ("div", "tags"), ("div", "masthead"), ("div", "topbar"), ("div", "legal"), ("div", "feedback"), ("div", "signup"), ("div", "promo-box"), ("aside", "related"), ("aside", "note"), ("ul", "nav"), ("ul", "breadcrumbs"), ("div", "comments-area"), ("div", "author-box"), ("table", "nav"), ("div", "warning")]
MAIN = [("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "article"), ("div", "post"), ("div", "entry-content"), ("div", "story"), ("div", "article-body"), ("section", ""), ("div", "main"), ("div", "text"), ("div", "page"), ("div", "entry"), ("div", "post-content"), ("div", "body-text"), ("td", "content"), ("section", "story"), ("main", "main"), ("div", "blog"), ("div", "single"), ("div", "news"), ("div", "item"), ("div", "article-text"), ("div", "main-content"), ("div", "storybody")]
ROLES = {("nav", ""): "navigation", ("header", ""): "banner", ("footer", ""): "contentinfo", ("aside", ""): "complementary", ("main", ""): "main", ("article", ""): "article", ("form", ""): "search"}
WRAPS = [("div", ""), ("div", "container"), ("div", "wrapper"), ("div", "row"), ("section", "")]
HIDDEN, INNER = 16, 24


def made_page(rng: random.Random) -> tuple[str, list[int]]:
    """A page and its blocks' labels."""
    out: list[str] = []
    labels: list[int] = []
    vocabulary = ["".join(rng.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "é", "sch", "os", "ción"]) for _ in range(rng.randint(1, 4))) for _ in range(80)]

    def say(low: int, high: int) -> str:
        n = rng.randint(low, high)
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", "", ",", ".", "***", "!!", "&amp;"][: rng.choice([6, 6, 6, 9])]) for _ in range(n)]
        return " ".join(words).capitalize() + rng.choice([".", ".", ".", "", "!"])

    def block(tag: str, text: str, label: int) -> None:
        text = rng.choice(["{}", "{}", "{}", "<b>{}</b>", "<i>{}</i> " + say(1, 3), "<a href='/x'>{}</a>"] if label else ["{}", "{}", "<a href='/x'>{}</a>", "<span>{}</span>"]).format(text)
        out.append(f"<{tag}>{text}" + rng.choice([f"</{tag}>", f"</{tag}>", f"</{tag}>", "<br>" if tag == "p" else f"</{tag}>"]))
        labels.append(label)

    def named(names: str, unknown: float) -> str:
        """As sites write it: as it is, glued to something, or a name of their own."""
        r = rng.random()
        if r < unknown:
            return "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(1, 9)))
        if r < 0.5 and names:
            return rng.choice(["site", "left", "right", "top", "my", "js", "c", "box", "the", "inner", "x"]) + rng.choice(["", "", "-", "_"]) + names.replace("-", rng.choice(["", "-", "_"])) + rng.choice(["", "", "1", "-wrap", "area"])
        return names

    def opened(kind: tuple[str, str], unknown: float = 0.2) -> str:
        tag, names = kind[0], named(kind[1], unknown if kind[0] in ("div", "section", "ul", "td", "table") else 0.1)
        if rng.random() < 0.06 and kind in ROLES:
            tag, names = "div", ""
            out.append(f'<div role="{ROLES[kind]}">')
        else:
            out.append(f"<{tag}" + (f' {rng.choice(["class", "class", "id"])}="{names}"' if names else "") + ">")
        return f"</{tag}>"

    def other(kind: tuple[str, str] | None = None) -> None:
        kind, form = kind or rng.choice(ASIDE), rng.random()
        links = rng.random() < 0.5 and "comment" not in kind[1]
        end = opened(kind, 0.4 if links else 0.05)
        if links and kind[0] in ("div", "nav", "aside", "header", "footer"):
            if form < 0.6:
                out.append("<ul>")
                for _ in range(rng.randint(2, 9)):
                    block("li", f"<a href='/x'>{say(1, 3)}</a>", 0)
                out.append("</ul>")
            else:
                out.append(rng.choice([" | ", " ", "<br>"]).join(f"<a href='/x'>{say(1, 3)}</a>" for _ in range(rng.randint(2, 8)))), labels.append(0)
        elif kind[0] == "table":
            out.append("<tr>")
            for _ in range(rng.randint(1, 6)):
                block("td", say(1, 3), 0)
            out.append("</tr>")
        elif kind[0] in ("ul", "ol") or (form < 0.35 and kind[0] != "form"):
            inner = kind[0] not in ("ul", "ol")
            out.append("<ul>" * inner)
            for _ in range(rng.randint(1, 9)):
                block("li", say(1, 30 if "comment" in kind[1] else 4), 0)
            out.append("</ul>" * inner)
        elif form < 0.6:
            out.append(say(2, 25)), labels.append(0)
        else:
            if rng.random() < 0.4:
                block(rng.choice(["h2", "h3", "h4"]), say(1, 4), 0)
            for _ in range(rng.randint(1, 5)):
                block(rng.choice(["p", "p", "div"]), say(1, 50), 0)
        if kind[0] == "form":
            out.append("<input name='q'>")
            block("button", say(1, 2), 0)
        out.append(end)

    def main_text() -> None:
        for _ in range(rng.choice([1, 2, 4, 8, 14])):
            r = rng.random()
            if r < 0.08:
                block(rng.choice(["h2", "h3"]), say(1, 8), 1)
            elif r < 0.14:
                end = opened((rng.choice(["ul", "ol"]), ""))
                for _ in range(rng.randint(1, 5)):
                    block("li", say(1, 15), 1)
                out.append(end)
            elif r < 0.18:
                end = opened(("blockquote", ""))
                block("p", say(3, 30), 1)
                out.append(end)
            elif r < 0.21:
                other()
            elif r < 0.25:
                other(rng.choice([("aside", ""), ("aside", "pullquote"), ("aside", "related"), ("aside", "note"), ("div", "ad"), ("div", "share"), ("div", "newsletter"), ("nav", "toc")]))
            elif r < 0.3:
                table()
            elif r < 0.34:
                end = opened(("figure", rng.choice(["", "image", "wp-caption"])))
                out.append("<img src='/p.jpg' alt='x'>")
                block(rng.choice(["figcaption", "p"]), say(1, 20), 1)
                out.append(end)
            elif r < 0.38:
                block(rng.choice(["pre", "h4", "address", "div", "div"]), say(1, 30), 1)
            elif r < 0.41:
                out.append("<dl>")
                for _ in range(rng.randint(1, 4)):
                    block("dt", say(1, 4), 1), block("dd", say(1, 20), 1)
                out.append("</dl>")
            elif r < 0.45:
                end = opened(rng.choice([("div", ""), ("section", ""), ("section", "chapter"), ("div", "paragraph"), ("div", "text-block")]))
                for _ in range(rng.randint(1, 4)):
                    block("p", say(1, 60), 1)
                out.append(end)
            else:
                block("p", say(1, rng.choice([3, 20, 60, 120])), 1)

    def table() -> None:
        """Data of the article: short cells in rows."""
        out.append(rng.choice(["<table>", "<table class='data'>", "<table class='wikitable'>"]))
        columns = rng.randint(1, 5)
        if rng.random() < 0.3:
            block("caption", say(1, 8), 1)
        for row in range(rng.randint(1, 6)):
            out.append("<tr>")
            for _ in range(columns):
                block("th" if row == 0 and rng.random() < 0.6 else "td", say(1, rng.choice([1, 3, 12])), 1)
            out.append("</tr>")
        out.append("</table>")

    out.append("<!DOCTYPE html><html><head>")
    block("title", say(1, 12), 0)
    out.append("<style>p{}</style><script>var t='</p>';</script></head><body>")
    usual = rng.random() < 0.25  # the commonest order: menu, notice, article, footer
    for _ in range(rng.randint(0, 4)) if not usual else ():
        other()
    if usual:
        out.append("<nav><ul>")
        for _ in range(rng.randint(2, 8)):
            block("li", f"<a href='/x'>{say(1, 1)}</a>", 0)
        out.append("</ul></nav><!-- x -->")
        other(("div", rng.choice(["ad", "ad", "notice", "cookie", "sidebar"])))
    ends = [opened(rng.choice(WRAPS)) for _ in range(rng.choice([0, 0, 1, 2]))] if not usual else []
    if not usual and rng.random() < 0.1:  # columns of a table
        out.append("<table><tr>")
        ends.append("</tr></table>")
        if rng.random() < 0.6:
            end = opened(("td", "sidebar"), 0.4)
            out.append("<ul>")
            for _ in range(rng.randint(2, 8)):
                block("li", f"<a href='/x'>{say(1, 2)}</a>", 0)
            out.append("</ul>" + end)
        ends.append(opened(("td", "content"), 0.4))
    else:
        ends.append(opened(("article", "") if usual or rng.random() < 0.35 else rng.choice(MAIN), 0.3))
    if rng.random() < 0.15:
        out.append("<header>")
        block("h1", say(2, 12), 1)
        out.append("</header>")
    elif rng.random() < 0.9:
        block("h1", say(2, 12), 1)
    main_text()
    if rng.random() < 0.2:
        other(rng.choice([k for k in ASIDE if "comment" in k[1] or "ad" in k[1] or "rel" in k[1]]))
    out.append("".join(reversed(ends)))
    for _ in range(rng.randint(0, 4)) if not usual else ():
        other()
    other(("footer", "")) if usual or rng.random() < 0.7 else None
    out.append(rng.choice(["</body></html>", ""]))
    return "".join(out), labels


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def run_lstm(x: np.ndarray, w: np.ndarray, u: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (steps, rows, HIDDEN) over x (steps, rows, INNER), and what
    the way back needs."""
    steps, rows, _ = x.shape
    h = c = np.zeros((rows, HIDDEN), x.dtype)
    out, kept = np.empty((steps, rows, HIDDEN), x.dtype), []
    given = x @ w + b
    for t in range(steps):
        z = given[t] + h @ u
        gates, g = sigmoid(z[:, : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        before, last = c, h
        c = f * c + i * g
        s = np.tanh(c)
        out[t] = h = o * s
        kept.append((i, f, o, g, before, last, s))
    return out, kept


def back_lstm(x: np.ndarray, u: np.ndarray, w: np.ndarray, dout: np.ndarray, kept: list) -> tuple[np.ndarray, ...]:
    dz_all = np.empty((len(x), x.shape[1], 4 * HIDDEN))
    dh = dc = np.zeros((x.shape[1], HIDDEN))
    du = np.zeros_like(u)
    for t in range(len(x) - 1, -1, -1):
        i, f, o, g, before, last, s = kept[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - s**2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * s * o * (1 - o), dc * i * (1 - g**2)], 1)
        dz_all[t] = dz
        du += last.T @ dz
        dh, dc = dz @ u.T, dc * f
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return dz_all @ w.T, x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(0)


def turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each row's own steps in reverse; what pads them stays behind."""
    at = np.arange(len(x))[:, None]
    back = lengths[None, :] - 1 - at
    return np.take_along_axis(x, np.where(back >= 0, back, at)[:, :, None], 0)


class Labeller:
    """Embeds blocks, runs an LSTM each way, and scores each block."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        new = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.p = {"e": rng.normal(0, 0.3, (WIDTH, INNER)), "eb": np.zeros(INNER), "v": new(2 * HIDDEN + INNER), "vb": np.zeros(1)}
        for way in "fb":
            self.p |= {f"w{way}": new(INNER, 4 * HIDDEN), f"u{way}": new(HIDDEN, 4 * HIDDEN), f"b{way}": np.zeros(4 * HIDDEN)}

    def forward(self, x: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, tuple]:
        p = self.p
        e = np.tanh(x @ p["e"] + p["eb"])
        back = turned(e, lengths)
        f, kept_f = run_lstm(e, p["wf"], p["uf"], p["bf"])
        b, kept_b = run_lstm(back, p["wb"], p["ub"], p["bb"])
        joined = np.concatenate([f, turned(b, lengths), e], 2)
        return sigmoid(joined @ p["v"] + p["vb"]), (e, back, kept_f, kept_b, joined)

    def gradients(self, x: np.ndarray, y: np.ndarray, lengths: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        out, (e, back, kept_f, kept_b, joined) = self.forward(x, lengths)
        real = np.arange(len(x))[:, None] < lengths[None, :]
        d = (out - y) * real / real.sum()
        dj = d[:, :, None] * p["v"]
        de_f, wf, uf, bf = back_lstm(e, p["uf"], p["wf"], dj[:, :, :HIDDEN], kept_f)
        de_b, wb, ub, bb = back_lstm(back, p["ub"], p["wb"], turned(dj[:, :, HIDDEN : 2 * HIDDEN], lengths), kept_b)
        de = (de_f + turned(de_b, lengths) + dj[:, :, 2 * HIDDEN :]) * (1 - e**2)
        return {"e": x.reshape(-1, WIDTH).T @ de.reshape(-1, INNER), "eb": de.sum((0, 1)), "v": (joined * d[:, :, None]).sum((0, 1)), "vb": np.array([d.sum()]), "wf": wf, "uf": uf, "bf": bf, "wb": wb, "ub": ub, "bb": bb}

    def scores(self, pages: list[np.ndarray], cells: int = 60_000) -> list[np.ndarray]:
        """Of each page's blocks. Pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = [i for i in sorted(range(len(pages)), key=lambda i: len(pages[i])) if len(pages[i])]
        while order:
            rows = max(1, min(len(order), cells // len(pages[order[-1]])))
            now, order = order[-rows:], order[:-rows]
            x, lengths = padded([pages[i] for i in now])
            p, _ = self.forward(x, lengths)
            for k, i in enumerate(now):
                out[i] = p[: lengths[k], k]
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in pages])
    x = np.zeros((lengths.max(), len(pages), WIDTH), np.float32)
    for k, page in enumerate(pages):
        x[: len(page), k] = page
    return x, lengths


@lru_cache(2)
def trained(pages: int = 900, epochs: int = 10, seed: int = 11, rate: float = 0.01) -> Labeller:
    """A labeller trained on ``pages`` made pages. The same arguments give the same one."""
    rng, model = random.Random(seed), Labeller(seed)
    made = []
    while len(made) < pages:
        html, labels = made_page(rng)
        found = blocks(html)
        if len(found) == len(labels):  # else one of its blocks has no text of its own
            made.append((features(found), np.array(labels, float)))
    mean, square = ({k: np.zeros_like(v) for k, v in model.p.items()} for _ in range(2))
    step = 0
    for epoch in range(epochs):
        order = sorted(range(pages), key=lambda i: (len(made[i][0]) // 8, rng.random()))
        batches = [order[i : i + 24] for i in range(0, pages, 24)]
        rng.shuffle(batches)
        for batch in batches:
            step += 1
            x, lengths = padded([made[i][0] for i in batch])
            y = np.zeros(x.shape[:2])
            for k, i in enumerate(batch):
                y[: lengths[k], k] = made[i][1]
            now = rate * (1 - epoch / epochs) + 1e-4
            for k, g in model.gradients(x, y, lengths).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.99 * square[k] + 0.01 * g**2
                model.p[k] -= now * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return model


def main_text(pages: DataFrame, model: Labeller | None = None, key: str = "page_id", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``key``, the columns ``keep``, ``text`` (the main blocks, a line each) and
    ``n_blocks`` of each page.

    A null or empty page, or one without main text, has an empty text. Equal
    pages have equal texts. An empty table gives an empty one. Null keys are
    kept; other columns are ignored.
    """
    model = model or trained()
    modest_batches(pages.sparkSession)
    rows = pages.select(key, *keep, F.coalesce("html", F.lit("")).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                found = [blocks(h) for h in b.column("_html").to_pylist()]
                scores = model.scores([features(x) for x in found])
                texts = ["\n".join(t for (_, t, _), p in zip(x, s, strict=True) if p >= 0.5) for x, s in zip(found, scores, strict=True)]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (key, *keep)), pa.array(texts, pa.string()), pa.array([len(x) for x in found], pa.int32())], names=[key, *keep, "text", "n_blocks"])

    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], StructField("text", StringType()), StructField("n_blocks", IntegerType())]))
