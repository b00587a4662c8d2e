import html
import random
import re

import pytest

from newsprep.llm import page_blocks
from newsprep.llm.page_blocks import blocks, extract_main_text, main_text, trained
from tests.llm.rows import collected

#: Pages that the tree has not been trained on: markup, and the text that must come out.
HELD_OUT = [
    (
        '<html><head><title>T</title></head><body class="has-sidebar"><div id="top-menu"><a href="/">Home</a>'
        '<a href="/n">News</a></div><div id="content"><h1>Water levels rise in the north</h1><p>The river rose by two '
        'metres within a day, and the town behind the old dam was cleared before night fell on Friday.</p><div '
        'class="ad-slot">Buy one, get one free, only this week.</div><p>Nobody was hurt.</p><p>More rain is due on '
        'Sunday, said the weather service in its <a href="/r">report</a> of this morning, and the dam will be watched '
        'by day and by night until the ground has dried.</p></div><div class="sidebar"><p>Our most popular stories of '
        'the week, chosen by readers.</p></div><div class="site-footer">All rights reserved.</div></body></html>',
        ["Water levels rise in the north",
         "The river rose by two metres within a day, and the town behind the old dam was cleared before night fell on Friday.",
         "Nobody was hurt.",
         "More rain is due on Sunday, said the weather service in its report of this morning, and the dam will be watched "
         "by day and by night until the ground has dried."],
    ),
    (
        "<body><header><h2>Daily</h2></header><nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><main>"
        "<h1>A short note<p>First paragraph without an end<p>Second &lt;b&gt; &amp;amp; &#233;&nbsp;&eacute; here.<ul>"
        "<li>item one<li>item two</ul></main><section id=user-comments><p>I do not agree with any of this, and I have "
        "said so many times before.</section><footer><p>Imprint and contact of the publisher.</footer>",
        ["A short note", "First paragraph without an end", "Second <b> &amp; é é here.", "item one", "item two"],
    ),
    (
        "<body><div role='banner'>The Paper</div><article><h1>Head</h1><p>Text before a script<script>if (a < b) "
        "document.write('</p><p>no</p>')</script> and after it.</p><form><p>Your mail address, please</p><input><button>Go"
        "</button></form><p>End.</p></article><div>Some other words of no interest to anyone.</div><!-- <p>unseen</p> -->",
        ["Head", "Text before a script and after it.", "End."],
    ),
]


@pytest.mark.parametrize(("page", "wanted"), HELD_OUT)
def test_pages_of_other_make(page, wanted):
    assert main_text(page, trained()).split("\n\n") == wanted


def test_cross_validation_by_page(monkeypatch):
    """Each labelled page is judged by a tree that has not seen its like."""
    pages, right, total = page_blocks.PAGES, 0, 0
    for i in range(len(pages)):
        monkeypatch.setattr(page_blocks, "PAGES", pages[:i] + pages[i + 1 :])
        tree = page_blocks.train(*page_blocks.labelled())
        monkeypatch.setattr(page_blocks, "PAGES", pages[i : i + 1])
        x, y = page_blocks.labelled()
        right += sum(tree.says(row) == bool(label) for row, label in zip(x, y))
        total += len(y)
    assert right / total >= 0.8, right / total


def article_by_pattern(page):
    body = re.search("<article>(.*)</article>", page, re.DOTALL)[1]
    pieces = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", body))
    return "\n\n".join(p for p in pieces if p)


def test_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    wanted = [
        (r["page_id"], r["url"], t, len(t))
        for r in df.collect() for t in [article_by_pattern(r["html"])]
    ]
    found = extract_main_text(df.withColumnRenamed("url", "address").selectExpr("*", "'x' AS text", "'y' AS key"), url="address")
    assert collected(found, "page_id", "address", "text", "n_chars") == sorted(wanted)


def test_blocks_in_order_with_their_words_and_links():
    found = blocks("<p>a <a href='x>y'>b c</a> d<br>e</p>tail &amp&am <div><a>f</a><p><a>g</p>h</div><3 <")
    assert [(b.text, b.words, b.linked) for b in found] == [
        ("a b c d e", 5, 2), ("tail &&am", 2, 0), ("f", 1, 1), ("g", 1, 1), ("h", 1, 0), ("<3 <", 2, 0)]


def test_awkward_pages(spark):
    draw = random.Random(3)
    parts = ["<", ">", "</", "<p", "<a href=\"", "'", "<!--", "-->", "<script>", "</script>", "&", "&#", "&amp", "text ",
             "<div class=x>", "</div>", "<article>", "\x00", "é", "<li>", "=", "<td>", "</p>", "<?x", "<h1>", "<br/>"]
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, None, " \n"), (3, "u", "no markup at all, only words.")]
    rows += [(i, "u", "".join(draw.choice(parts) for _ in range(60))) for i in range(10, 300)]
    rows += [(4, "u", "<div>" * 50_000 + "deep" + "</div>" * 50_000), (5, "u", "<p>word " * 200_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = extract_main_text(df).collect()
    assert len(found) == len(rows)
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    by_id = {r["page_id"]: r["text"] for r in found}
    assert by_id[None] == by_id[1] == by_id[2] == ""
    assert by_id[5].count("word") == 200_000
    assert extract_main_text(df.limit(0)).count() == 0
