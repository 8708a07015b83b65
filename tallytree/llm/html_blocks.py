"""Blocks of an HTML page: the leaf sequence that the labeller reads."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from zlib import crc32

import numpy as np

from .wordhash import LETTERS, span_hashes, sums, word_spans

#: Elements that start a new block, that have no content, whose
#: content isn't text, and that end an open paragraph or item of their own kind.
BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul button textarea".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template iframe svg math object xmp noframes noembed".split())
#: Of these, what may end in its own start tag ("/>"); and elements whose content is text without tags.
FOREIGN, PLAIN_TEXT = {"svg", "math"}, {"title", "textarea"}
ENDS_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS_ITEMS = {"ul", "ol", "menu", "dl", "table", "select"}
#: A quote opens a value after "=" alone; anywhere else it is a letter like any other.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*"[^"]*"|=\s*'[^']*'|=\s*[^\s>"'][^\s>]*+|=)*+)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
#: Parts of class and id names that many sites use, also glued to others ("leftnav").
PARTS = "nav menu foot head side comment repl content article main body entry post story item text share social ad promo banner cookie consent notice related sign letter subscri login form search widget bread tag copy legal author".split()
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

PATH, WORDS, PLAIN = 256, 32, 8
WIDTH = PATH + WORDS + PLAIN


class Open:
    """An open element. ``row``, the hashed tag path down to it, is made from its
    parent's once, however many blocks are below."""

    __slots__ = ("tag", "name", "parent", "depth", "linked", "_row")

    def __init__(self, tag: str, name: str, parent: Open | None):
        self.tag, self.name, self.parent, self._row = tag, name, parent, None
        self.depth = parent.depth + 1 if parent else 1
        self.linked = tag == "a" or (parent is not None and parent.linked)

    def row(self) -> np.ndarray:
        made, node = [], self
        while node is not None and node._row is None:
            made.append(node)
            node = node.parent
        for node in reversed(made):
            node._row = node.parent._row.copy() if node.parent else np.zeros(PATH, np.uint8)
            tag, *names = re.split(r"[\s_-]+", node.name)
            parts = ("~" + part for x in names for part in PARTS if part in x)
            for x in (tag, *("." + x for x in names), *parts):
                node._row[crc32(x.encode()) % PATH] = 1
        return self._row

    def path(self) -> list[str]:
        """Names of the open elements, outermost first."""
        out, node = [], self
        while node is not None:
            out.append(node.name)
            node = node.parent
        return out[::-1]


Block = tuple[Open | None, str, int]


def blocks(html: str) -> list[Block]:
    """Of each block with text: the innermost open element (its name has its
    class, id and role), the text (references decoded, white space as one
    space), and how many of its characters are in links."""
    out: list[Block] = []
    stack: list[Open] = []
    opened: Counter = Counter()  # open elements by tag, so that no search goes down a stack in vain
    parts: list[str] = []
    linked = at = 0

    def flush(inside: Open | None = None) -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((inside or (stack[-1] if stack else None), text, min(linked, len(text))))
        parts.clear()
        linked = 0

    def put(piece: str) -> None:
        nonlocal linked
        parts.append(piece)
        if stack and stack[-1].linked:
            linked += len(piece)

    def shut(depth: int) -> None:
        for x in stack[depth:]:
            opened[x.tag] -= 1
        del stack[depth:]

    for m in iter(lambda: TOKEN.search(html, at), None):
        if m.start() > at:
            put(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                flush()
            if opened[tag] > 0:
                depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].tag == tag)
                if tag not in BLOCK and any(x.tag in BLOCK for x in stack[depth:]):
                    continue  # an inline end tag doesn't close blocks
                shut(depth)
            elif tag == "br":
                parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
            while stack and stack[-1].tag not in BLOCK:  # inline elements end with their block
                shut(len(stack) - 1)
            if stack and stack[-1].tag == "p":
                shut(len(stack) - 1)
            if any(opened[x] > 0 for x in ENDS_SAME.get(tag, ())):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i].tag in HOLDS_ITEMS:
                        break
                    if stack[i].tag in ENDS_SAME[tag]:
                        shut(i)
                        break
        if tag in RAW:
            if tag not in FOREIGN or not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            continue
        if tag in VOID:
            parts.append(" ")
            continue
        names = " ".join("".join(x) for x in NAMES.findall(m[3])) if "=" in m[3] else ""
        element = Open(tag, f"{tag} {names.lower()}" if names else tag, stack[-1] if stack else None)
        if tag in PLAIN_TEXT:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            put(html[at : end.start() if end else len(html)])
            at = end.end() if end else len(html)
            flush(element)
            continue
        stack.append(element)
        opened[tag] += 1
    if at < len(html):
        put(html[at:])
    flush()
    return out


def features(found: list[Block]) -> np.ndarray:
    """What the labeller reads of each block: hashed tag path, hashed words, and
    a few plain numbers."""
    n = len(found)
    out = np.zeros((n, WIDTH), np.float32)
    raws = [t.encode() for _, t, _ in found]
    raw = np.frombuffer(b"".join(raws), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in raws])]).astype(np.int64)
    start, end, of = word_spans(raw, off, LETTERS)
    h = span_hashes(sums(raw, lower=True), start, end) >> np.uint64(59)
    counts = np.bincount(of * WORDS + h.astype(np.int64), minlength=n * WORDS).reshape(n, WORDS)
    out[:, PATH : PATH + WORDS] = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    words = counts.sum(1)
    for i, (inside, text, linked) in enumerate(found):
        if inside is not None:
            out[i, :PATH] = inside.row()
            out[i, crc32(b">" + inside.tag.encode()) % PATH] = 1
        out[i, PATH + WORDS :] = [
            min(np.log1p(words[i]) / 5, 2), linked / len(text), text[-1] in ".!?…", (text.count(",") + text.count(".")) / len(text) * 10,
            inside is not None and inside.tag in HEADINGS, i / n, (n - i) / n, min(inside.depth if inside else 0, 12) / 12,
        ]
    return out
