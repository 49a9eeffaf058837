"""Main text of pages: labelled layouts, the given pages, awkward markup."""

import html
import re

import pytest
from pyspark.sql import functions as F

from airloom.llm import extraction, queries

from .conftest import CLASHING

SF = "/root/testdata/sf0.01"
TEXT = "The council met on Tuesday and spoke of the bridge, which has been closed since the flood of last year."
MORE = "Repairs are to begin in spring; the river is watched by the town, and by those who live along its banks."


@pytest.fixture(scope="module")
def weights():
    return extraction.fit([(*k, float(n)) for k, n in sorted(extraction.examples().items())])


def inside_article(page):
    """The blocks of the element article of the given pages, by plain cutting."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL).group(1)
    blocks = (re.sub(r"<[^>]*>", "", part) for part in re.split(r"<(?:p|/p|h1|/h1|br)>", inner))
    return "\n".join(filter(None, (" ".join(html.unescape(b).split()) for b in blocks)))


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: inside_article(r.html) for r in pages.collect()}
    rows = queries.op11_extraction(spark, SF).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


LAYOUTS = [
    f"<body><header><a href='/'>Town News</a></header><main><h1>Bridge</h1><p>{TEXT}</p><p>{MORE}</p></main><footer>All rights</footer>",
    f"<body><div id='cookie-notice'><p>We use cookies.</p><button>OK</button></div><div class='content'><h1>Bridge</h1><p>{TEXT}"
    f"<div class='advert'>Buy now</div><p>{MORE}</div><aside class='sidebar'><h3>Most read</h3><ul><li><a>One</a></ul></aside>",
    f"<article><header><h1>Bridge</h1></header><p>{TEXT}</p><form><p>Your mail</p><input></form><p>{MORE}</p></article>"
    "<section id='comments'><h2>Two comments</h2><article class='comment'><p>I agree with all that has been said here and more.</p></article></section>",
    f"<table><tr><td><a href=x>Home</a><td><h1>Bridge</h1><p>{TEXT}</p><p>{MORE}</p></table><div class='footer'>Imprint</div>",
    f"<nav class='breadcrumb'><a>Home</a></nav><div class='post'><h1>Bridge</h1><p>{TEXT}</p><script>if (a < b) document.write('<p>no</p>')</script>"
    f"<style>p {{}}</style><noscript>Turn it on</noscript><!-- <p>no</p> --><p>{MORE}</p></div><div class='share'><a>Share</a></div>",
]


@pytest.mark.parametrize("page", LAYOUTS)
def test_layouts(weights, page):
    assert extraction.main_text(page, weights) == f"Bridge\n{TEXT}\n{MORE}"


def test_examples_are_read_as_they_are_labelled(weights):
    pages = list(extraction.example_pages())
    read = [extraction.main_text(page, weights) for page in pages]
    right = [t.count("yes") == page.count("yes") and "no" not in t for t, page in zip(read, pages, strict=True)]
    assert sum(right) > 0.95 * len(right)


def test_markup(weights):
    def text(inner):
        return extraction.main_text(f"<article>{inner}</article>", weights)

    assert text("<p>a &amp; b&nbsp;&#99; &lt;x&gt; &xyzzy;") == "a & b c <x> &xyzzy;"
    assert text("<p> one\n\t two <b>th</b>ree</p><p></p><p>four<br>five") == "one two three\nfour\nfive"
    assert text("<P TITLE='a > b' data-x=\"</p>\">one</P>2 < 3 <3") == "one\n2 < 3 <3"
    assert text("<p>one<!-- two --><!-->three<?php four ?>") == "onethree"
    assert text("<ul><li>one<li>two<ul><li>three</ul></ul>") == "one\ntwo\nthree"
    assert text("<p>" + "word " * 300_000).count("word") == 300_000
    assert text("<i>" * 3000 + "deep" + "</i>" * 3000) == "deep"
    for broken in ("<", "<a", "<!--", "</", "<p title='", "<script>x", "&", "<a b='" * 1000, "<!" * 1000):
        assert extraction.main_text(broken, weights) is not None


def test_best_region_is_the_best_of_all(weights):
    scores = [1.0, -3.0, 2.0, 0.5, -1.0, 4.0, -9.0, 5.0]
    spans = [(sum(scores[i : j + 1]), i, j) for i in range(8) for j in range(i, 8)]
    best = max(spans)
    assert extraction.best_region(scores) == (best[1], best[2]) and extraction.best_region([-1.0]) == (0, -1)


def test_awkward_pages(spark):
    columns = "page_id long, url string, html string" + "".join(f", `{c}` string" for c in CLASHING)
    rows = [(1, None, None), (2, "u", ""), (3, "u", "no markup at all, only words"), (None, None, LAYOUTS[0]), (4, "v", LAYOUTS[0]),
            (4, "v", LAYOUTS[0]), (5, "w", "<nav><a>Home</a></nav>"), (6, "x", "<p>" + "long " * 100_000)]
    pages = spark.createDataFrame([(*r, *CLASHING) for r in rows], columns)
    found = extraction.extract_main_text(pages).collect()
    assert found[0].asDict().keys() == {"page_id", "url", "text", "n_chars"} and len(found) == len(rows)
    texts = [(r.page_id, r.url, r.text) for r in found]
    assert texts[0] == (1, None, "") and texts[1] == (2, "u", "") and texts[3][2] == texts[4][2] == f"Bridge\n{TEXT}\n{MORE}"
    assert texts[6][2] == "" and texts[7][2].count("long") == 100_000
    assert extraction.extract_main_text(pages.limit(0)).count() == 0
    assert extraction.extract_main_text(pages.where(F.col("html").isNull())).first().text == ""
