import html
import re

import numpy as np
import pytest

from newsloom.llm import pages

TREE = pages.fit(*pages.labelled_table())
LONG = "Sentence after sentence of the story goes on and on, with more words than any menu has. " * 3


def text_of(page):
    found = pages.blocks(page)
    return "\n".join(b.text for b, k in zip(found, pages.judge(TREE, pages.described(found)) >= 0.5) if k)


@pytest.mark.parametrize("page, want", [
    ("", ""),
    ("plain words only, no markup at all, but long enough to be read as the text of this page. " + LONG, None),
    ("<nav><a href=/>Home</a></nav><article><h1>Title &amp; more</h1><p>One<br>two&nbsp; three <b>bo</b>ld</article><footer>&copy; me</footer>",
     "Title & more\nOne two three bold"),
    ("<article><p>Is.<p>In. <div class='ad-slot x'>Buy now, it is cheap.</div><p>Of it.</p><section id=comments><p>" + LONG + "</p></section></article>", "Is.\nIn.\nOf it."),
    ("<main><p>Kept text here.</p><form><p>Your name</p><input value=x></form><p>More <script>if (a < b) { '</p>' }</script>of it.</p></main><aside>" + LONG + "</aside>",
     "Kept text here.\nMore of it."),
    ("<body class='has-sidebar'><div class='page sidebar-left'><article><p>Body &lt;b&gt; &#233;&#x41;&unknown; &am</p></article></div>", "Body <b> éA&unknown; &am"),
    ("<article><p>Before</p><!-- <p>not this</p> --><style>p{}</style><p title=\"a>b\">after</p><p title=don't>odd</p></article>", "Before\nafter\nodd"),
    ("<article><header><h1>Head</h1></header><p>x</p><p role=alert>Notice!</p><p hidden>no</p><nav><a href=x>y</a></nav></article><p>" + LONG, "Head\nx"),
    ("<article><p>cut off <b>here<scr", "cut off here"),
    ("<article><p>unclosed script</p><script>var t = 1; <p>" + LONG, "unclosed script"),
    ("<div class=cookie-consent>" + LONG + "</div><div class=entry-content><ul><li>One item<li>Two</ul><p>Yes.</p></div><div class=related><p>" + LONG + "</p></div>", "One item\nTwo\nYes."),
])
def test_pages(page, want):
    assert text_of(page) == (" ".join(page.split()) if want is None else want)


def test_deep_and_long_pages():
    assert text_of("<div>" * 50_000 + "<article><p>deep" + "</div>" * 50_000) == "deep"
    text_of("<div>" * 50_000 + "<article><p>x" + "</section></p>" * 50_000)
    page = "<article>" + "<p>" + "word " * 400_000 + "</p><p>end." * 3 + "</article>"
    assert len(text_of(page)) == 5 * 400_000 - 1 + 3 * 5
    for broken in ('<a "', "<p '", "<", "<!--", "&", "<a href='x' "):
        text_of("<article><p>x " + broken * 20_000)


def test_tree_fits_its_table_and_left_out_pages():
    x, y = pages.labelled_table()
    assert ((pages.judge(TREE, x) >= 0.5) == y).mean() > 0.98
    # Leave each labelled page out in turn: the tree fitted on the others still places most blocks.
    right = total = 0
    for i, held in enumerate(pages.LABELLED):
        rest = [p for j, p in enumerate(pages.LABELLED) if j != i]
        keep, pages.LABELLED[:] = list(pages.LABELLED), rest
        tree = pages.fit(*pages.labelled_table())
        pages.LABELLED[:] = [held]
        a, b = pages.labelled_table()
        pages.LABELLED[:] = keep
        right += ((pages.judge(tree, a) >= 0.5) == b).sum()
        total += len(b)
    assert right / total > 0.9


def test_query_returns_the_article_of_every_page(spark, small):
    from newsloom.llm.queries import op11_main_text
    raw = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = op11_main_text(spark, small).collect()
    assert len(got) == len(raw)
    for r in got:
        article = re.sub("<[^>]*>", " ", raw[r["page_id"]].split("<article>")[1].split("</article>")[0])
        assert r["text"].split() == html.unescape(article).split() and r["n_chars"] == len(r["text"])


def test_table_cases(spark):
    schema = "page_id long, url string, html string, text int, n_chars string, n_main double, own string"
    page = "<article><p>Text of it.</article>"
    rows = [(1, "u", page, 5, "a", 1.0, "z"), (1, "u", page, 5, "a", 1.0, "z"), (None, None, page, None, None, None, None), (2, None, None, 5, "a", 1.0, None), (3, "", "", 5, "a", 1.0, None)]
    df = spark.createDataFrame(rows, schema)
    out = pages.main_text(df)
    assert out.columns == ["page_id", "url", "own", "text", "n_chars", "n_blocks", "n_main"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [
        (1, "u", "z", "Text of it.", 11, 1, 1)] * 2 + [(None, None, None, "Text of it.", 11, 1, 1), (2, None, None, "", 0, 0, 0), (3, "", None, "", 0, 0, 0)]))
    assert pages.main_text(df.limit(0)).collect() == []


def test_described_neighbours():
    row = pages.described(pages.blocks("<p><a href=x>one two</a></p><p>three <a href=x>four</a></p><p>five</p>"))
    assert np.allclose(row[1, :6], [2, 0.5, 2, 1, 1, 0]) and np.allclose(row[0, 2:4], 0)
