"""Main text against a plain reading of the given pages, labellings against all labellings, and held-out layouts."""

import html
import itertools
import random
import re

import numpy as np
import pytest

from tests.llm.helpers import SF_DIR, by_key
from tidegauge.llm import html_crf as hc

SCHEMA = "page_id long, url string, html string, text string, n_chars int, main_text string"


def plain_article(page):
    """The paragraphs and the heading between the article's tags: how the given pages are built."""
    article = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", article[1]) if article else []
    texts = [" ".join(html.unescape(re.sub("<[^>]+>", " ", part)).split()) for part in parts]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def chain(spark):
    return hc.fit(hc.sample_of(spark.read.parquet(f"{SF_DIR}/pages.parquet")))


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    want = [(r.page_id, r.url, t := plain_article(r.html), len(t)) for r in pages.collect()]
    assert by_key(hc.main_texts(pages).collect()) == by_key(want) and any(r[3] for r in want)


def test_odd_rows_and_empty_table(spark):
    page = "<article><h1>A title</h1><p>Some text that goes on, and on, until it ends.</p></article>"
    long = "<article><h1>Long</h1>" + "<p>A paragraph of words, as there are many in it.</p>" * 20_000 + "</article>"
    htmls = [None, "", "  \n", "no markup at all", "<<<>>> & < 3", "<p", "<!-- open", "<script>never closed <p>text</p>", page, page, long, "<div>" * 3_000 + "deep"]
    rows = [(i if i % 5 else None, None if i % 3 else "u", h, "x", 1, "y") for i, h in enumerate(htmls)] + [(8, "u", page, None, None, None)] * 2
    got = hc.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    texts = {r.page_id: r.text for r in got}
    assert texts[1] == texts[2] == "" and texts[8] == "A title\nSome text that goes on, and on, until it ends."
    assert max(r.n_chars for r in got) > 20_000 * 40
    assert hc.main_texts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_blocks_of_a_page():
    page = """<!DOCTYPE html><html><head><title>The &amp; title</title><style>p{}</style></head><body class=x>
      <ul><li>one<li>two <b>bo</b>ld</ul><p>first<br>line&nbsp;&lt;b&gt;<p>second <a href="a>b">li\tnk</a>
      <!-- <p>no</p> --><script>var t="</p>";</script><table><tr><td>c1<td>c2</table>tail</p> 1 < 2 &unknown; &#233;</body></html>"""
    blocks = hc.Reader().blocks(page)
    assert [(b.element.tag, b.text) for b in blocks] == [
        ("li", "one"), ("li", "two bold"), ("p", "first line <b>"), ("p", "second li nk"), ("td", "c1"), ("td", "c2"),
        ("body", "tail"), ("body", "1 < 2 &unknown; é"),
    ]
    assert [b.text for b in blocks if "link=0" not in b.features] == ["second li nk"]


def test_held_out_layouts_and_classes(chain):
    """Pages put together in ways that training has not seen."""
    layouts = [
        "div.page>div.masthead.header=name div.page>ul.navigation>li=link*5 div.page>div.article.text>h1=title! div.page>div.article.text>p=prose*6! div.page>div.related>p=short*2 div.page>div.comments>p=remark*4 div.page>div.footer=rights",
        "header=name div.cookies=notice article>h1=title! article>p=prose*3! article>div.advertisement>p=short article>p=prose*3! article>div.comment>p=remark*3 footer=rights",
        "section.menu>ul>li=link*4 section.content>h1=title! section.content>h3=heading! section.content>p=prose*5! section.widget>p=short section.reply>p=remark footer=rights",
    ]
    rng, words = random.Random(99), "la que de los wenn nicht über the and of with écran très für".split()
    right = total = 0
    for layout in layouts * 40:
        page, labels = hc.labelled_page(layout, words, rng)
        got = chain.labels(hc.Reader().blocks(page))
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total > 0.95


def test_viterbi_against_all_labellings(chain):
    page, _ = hc.labelled_page(hc.LAYOUTS[0], ["ein", "Wort", "mehr"], random.Random(1))
    blocks = hc.Reader().blocks(page)[:11]

    def score(labels):
        own = sum(sum(chain.weights.get(f, 0.0) for f in [*b.element.features, *b.features]) for b, y in zip(blocks, labels) if y)
        pairs = zip(blocks, blocks[1:], labels, labels[1:])
        return own + sum(chain.steps[a.element is b.element][y][z] for a, b, y, z in pairs)

    best = max(itertools.product([False, True], repeat=len(blocks)), key=score)
    assert score(chain.labels(blocks)) == pytest.approx(score(best))
    assert chain.labels([]) == []


def test_training_follows_the_labels(chain):
    """The fitted field explains its own training pages, and fitting again gives the same field."""
    right = [y == b.main for blocks in hc.training_pages([]) for b, y in zip(blocks, chain.labels(blocks))]
    assert np.mean(right) > 0.97
    assert hc.fit([], seed=3).weights == hc.fit([], seed=3).weights
