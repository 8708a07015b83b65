"""HTML extraction on made pages, and chat formatting by exact round trip."""

import random
import time
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import layouts
from tallytree.llm import chat, html_blocks, html_extract
from tallytree.llm.queries import ORACLE_SQL, op9_chat_formatting

PAGE = """<!DOCTYPE html><html><head><title>Head</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav><!-- ad --><div class="ad">Buy this now.</div>
<article><h1>The title &amp; more</h1><p><b>First line.<br><p>Second&nbsp;&#233;   line
 goes on.</p><p>Third.</p></article><div class="comments"><p>I liked it.</p></div><form><input name="q"><button>Go</button></form><footer>&copy; us</footer>"""


def test_blocks_of_a_page():
    found = html_blocks.blocks(PAGE)
    assert [t for p, t, _ in found if "article" in p.path()] == ["The title & more", "First line.", "Second é line goes on.", "Third."]
    assert found[1][2] == 3  # all of it is a link's


BROKEN = {
    "": [], "<": ["<"], "<p": [], "a < b": ["a < b"], "<!--": [], "<script>x": [], "</p></div>": [], "<p>a<p>b": ["a", "b"],
    "<ul><li>a<li>b</ul>": ["a", "b"], "<table><tr><td>a<td>b": ["a", "b"], "&bogus; &lt": ["&bogus; <"], "<a href='>'>x</a>": ["x"],
    '<script src="a.js"/>var x=1;</script>y': ["y"], "<svg/>a<svg><p>b</p></svg>c": ["ac"], '<p title="it"s">one</p>': ["one"],
    "<p title=it's>Two is here.</p><p>Three isn't <b>four</b>": ["Two is here.", "Three isn't four"], '<p class="a"">x</p>': ["x"],
    "<title>a <b> c</title>d": ["a <b> c", "d"], '<p a=">">x': ["x"], '<p a="x': [], "<p>a</i>b</p>": ["ab"], "a<br>b</br>c": ["a b c"],
}


@pytest.mark.parametrize("html", BROKEN)
def test_broken_pages_have_these_blocks(html):
    assert [t for _, t, _ in html_blocks.blocks(html)] == BROKEN[html]


@pytest.mark.parametrize("html", ["<div class=a>x" * 20_000, "<div>" * 4000 + "</x>" * 20_000 + "<li>q" * 5000, "<p a=\"" * 20_000, "<p" + " a=" * 200_000, "<p>" + "word &amp; " * 400_000])
def test_deep_and_long_pages_take_no_square_of_time(html):
    began = time.process_time()
    html_blocks.features(html_blocks.blocks(html))
    assert time.process_time() - began < 6


def test_other_layouts_are_read():
    model, right, total = html_extract.trained(), 0, 0
    for shape in range(layouts.SHAPES):
        rng = random.Random(shape)
        for _ in range(30):
            html, want = layouts.page(rng, shape)
            found, want = html_blocks.blocks(html), Counter(want)
            for (_, text, _), p in zip(found, model.scores([html_blocks.features(found)])[0], strict=True):
                right += (p >= 0.5) == (want[text] > 0)
                want[text] -= 1
                total += 1
    assert right / total > 0.95


def test_the_labeller_knows_made_pages():
    model, rng, wrong, total = html_extract.trained(), random.Random(77), 0, 0
    for _ in range(60):
        html, labels = html_extract.made_page(rng)
        found = html_blocks.blocks(html)
        if len(found) == len(labels):
            scores = model.scores([html_blocks.features(found)])[0]
            wrong += sum((s >= 0.5) != y for s, y in zip(scores, labels, strict=True))
            total += len(labels)
    assert wrong / total < 0.04


def test_main_text_of_odd_tables(spark):
    rows = [(1, "u", PAGE, "x", 1), (2, None, None, "x", 1), (3, "v", "", "x", 1), (None, "w", PAGE, "x", 1), (1, "u", PAGE, "x", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_blocks int")
    got = sorted((r["page_id"] or 0, r["text"]) for r in html_extract.main_text(df).collect())
    text = "The title & more\nFirst line.\nSecond é line goes on.\nThird."
    assert got == [(0, text), (1, text), (1, text), (2, ""), (3, "")]
    assert html_extract.main_text(df.limit(0)).count() == 0


HARD = st.lists(st.sampled_from(["\\", "#", "###", "### ", "</turn>", "</turn", ">", "\n", ": ", "a", "é", "Assistant", "<"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "Tool", "a:b\\", ""]), HARD), max_size=5))
def test_formatting_is_reversible(messages):
    text, spans = chat.render(messages)
    assert chat.parse(text) == messages
    assert chat.loss_text(text, spans) == "".join(t for role, t in messages if role == "assistant")


def test_events_are_folded(spark):
    log = [
        (1, 1, "start", "m1", "user", "Hi"), (1, 3, "delta", "m2", "assistant", " there"), (1, 2, "start", "m2", "assistant", "Hel"), (1, 4, "regenerate", "m2", None, "Good "),
        (1, 5, "delta", "m2", None, "day"), (1, 6, "edit", "m1", None, "Hello"), (1, 7, "start", "m3", "user", "x"), (1, 8, "retract", "m3", None, None), (None, 1, "delta", None, "user", "alone"),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, op string, message string, role string, text string")
    got = {r["conv_id"]: chat.parse(r["formatted"]) for r in chat.formatted(events).collect()}
    assert got == {1: [("user", "Hello"), ("assistant", "Good day")], None: [("user", "alone")]}
    assert chat.formatted(events.limit(0)).count() == 0
    with pytest.raises(Exception, match="unknown event"):
        chat.formatted(spark.createDataFrame([(1, 1, "bend", "m", "user", "")], events.schema)).collect()


def test_rows_become_conversations(spark, tmp_path):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, None, None, "first"), (2, 0, "user", "x"), (2, 0, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in op9_chat_formatting(spark, str(tmp_path)).collect()}
    assert {k: (v["n_turns"], v["loss_chars"]) for k, v in got.items()} == {1: (3, 1), 2: (2, 0), -7: (2, 26)}


def test_rows_that_repeat_keep_their_texts(spark, tmp_path):
    rows = [(2, 0, "user", "x")] * 2 + [(3, 1, "assistant", "yes")] * 3 + [(3, 0, "user", "y"), (3, 1, "assistant", "no"), (3, 1, None, None), (3, 1, "", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: r for r in chat.formatted(chat.events_of_rows(df)).collect()}
    assert {k: chat.parse(r["formatted"]) for k, r in got.items()} == {
        2: [("user", "x")] * 2,
        3: [("user", "y"), ("", ""), ("", ""), ("assistant", "no"), *[("assistant", "yes")] * 3],
    }
    assert [r["formatted"][s["start"] : s["end"]] for r in [got[3]] for s in r["loss"]] == ["no", "yes", "yes", "yes"]
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(ORACLE_SQL["op9_chat_formatting"])
    assert sorted(map(tuple, op9_chat_formatting(spark, str(tmp_path)).select(*want.columns).collect())) == sorted(want.fetchall())
