"""Main text of pages: markup of many kinds, hostile pages, and minimum cuts by trying all labellings."""

import html
import itertools
import re
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import registry
from tidemark.llm.extraction import content_blocks, extract_main_text, log_odds, main_text, read_page
from tidemark.llm.mincut import CutGraph

SF_DIR = "/root/testdata/sf0.01"
ODDS = log_odds({})
PROSE = "The river rose again in the night, and by morning the lower fields were under water. Nobody had expected it so early in the year."
SHORT = "It rained."
MENU = "".join(f'<li><a href="/{k}">Part {k}</a></li>' for k in range(6))

PAGES = {
    "semantic": (
        f"<html><head><title>T</title><style>p{{}}</style></head><body><header><a href='/'>Site</a></header><nav><ul>{MENU}</ul></nav>"
        f"<main><article><header><h1>Flood</h1></header><p>{PROSE}</p><aside>{PROSE}</aside><p>{SHORT}</p><ul><li>one</li><li>two</li></ul>"
        f"<section class='comments'><p>{PROSE}</p></section><form><label>Mail</label><p>{PROSE}</p></form></article></main>"
        f"<aside class='sidebar'><p>{PROSE}</p></aside><footer><p>{PROSE}</p></footer></body></html>",
        ["Flood", PROSE, SHORT, "one", "two"],
    ),
    "classes": (
        f"<body><div id='header'>Site name</div><div class='top-nav'><ul>{MENU}</ul></div><div id='cookieNotice'>{PROSE}</div>"
        f"<div class='post-content'><h2>Flood</h2><p>{PROSE}</p><div class='ad-slot'>{PROSE}</div><p>{SHORT}<p>{PROSE}</div>"
        f"<div class='related-posts'><article><h3>Other</h3><p>{PROSE}</p></article></div><div id='comments'><article><p>{PROSE}</p></article></div>"
        f"<div class='site-footer'>{PROSE}</div>",
        ["Flood", PROSE, SHORT, PROSE],
    ),
    "bare": (
        f"<body><ul>{MENU}</ul><div><h1>Flood in the valley</h1><p>{PROSE}</p><p>{SHORT}</p><p>{PROSE}</p></div>"
        "<div><a href='/a'>Terms</a> <a href='/b'>Help</a></div>",
        ["Flood in the valley", PROSE, SHORT, PROSE],
    ),
    "roles": (
        f"<div role=navigation>{PROSE}</div><div role='main'><p>{PROSE}</p></div><div role='contentinfo'><p>{PROSE}</p></div>",
        [PROSE],
    ),
    "text": (
        "<article><p>a &lt;b&gt; &amp;amp; caf&eacute;&#33;<br>new\n\t line&nbsp;x <b>bo</b>ld <!-- <p>no</p> -->&copy 1 < 2 </p><script>var s='</p>';</SCRIPT>"
        "<p title='a > b'>second</p><noscript>no</noscript><p></p>tail</article>",
        ["a <b> &amp; café! new line x bold © 1 < 2", "second", "tail"],
    ),
    "cut off": (f"<article><h1>Flood</h1><p>{PROSE}</p><p>the en<a hre", ["Flood", PROSE, "the en"]),
    "article outside of main words": (f"<article><p>{SHORT}</p></article><div><p>{PROSE}</p></div>", [SHORT]),
    "nothing": ("<script>x", []),
    "empty": ("", []),
    "no markup": (PROSE, [PROSE]),
    "only a menu": (f"<nav>{MENU}</nav>", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_pages_of_many_kinds(name):
    source, expected = PAGES[name]
    assert main_text(source, ODDS) == "\n".join(expected)


def test_query_gives_the_articles(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    found = {r.page_id: r for r in registry.op13_cut_extraction(spark, SF_DIR).collect()}
    assert len(found) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)(</article>|$)", page.html, re.S).group(1)
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        row = found[page.page_id]
        assert row.text == "\n".join(filter(None, blocks)) and row.n_chars == len(row.text) and row.url == page.url


def test_hard_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", PAGES["bare"][0]), (3, "w", PAGES["bare"][0]), (3, "w", PAGES["bare"][0])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("id", "text", "n_chars", "name", "label", "n"):
        df = df.withColumn(name, F.lit("own"))
    found = extract_main_text(df)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    text = "\n".join(PAGES["bare"][1])
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (None, "v", text, len(text)), (3, "w", text, len(text)), (3, "w", text, len(text))], key=repr
    )
    assert extract_main_text(df.where("false")).collect() == []


@pytest.mark.parametrize(
    "source",
    [
        "<div>" * 20_000 + "".join(f"word {k}.</div>" for k in range(20_000)),
        "<div><p>" * 5_000 + PROSE,
        "<script>" * 20_000,
        "<!--" * 20_000,
        "<a href=\"" * 20_000,
        "<p a=" * 20_000,
        "< p" * 20_000 + "</" * 20_000 + "&" * 20_000,
        f"<p>{SHORT}</p><li><a>x</a></li>" * 5_000,
        "<p " + "= " * 50_000 + ">" + PROSE,
        "<textarea>" + "İ" * 10_000 + "</textarea>" + PROSE,
    ],
)
def test_hostile_pages_take_bounded_time(source):
    begun = time.time()
    main_text(source, ODDS)
    assert time.time() - begun < 30


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=7),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6), st.integers(0, 9)), max_size=14),
)
def test_cuts_cost_the_least_of_all_labellings(costs, edges):
    n = len(costs)
    edges = [(a, b, c) for a, b, c in edges if a < n and b < n and a != b]
    graph = CutGraph(n)
    for node, (source, sink) in enumerate(costs):
        graph.cost(node, source, sink)
    for edge in edges:
        graph.edge(*edge)

    def total(side):
        return sum(c[0] if s else c[1] for s, c in zip(side, costs)) + sum(c for a, b, c in edges if side[a] != side[b])

    assert total(graph.source_side()) == min(map(total, itertools.product((False, True), repeat=n)))


def test_labels_of_a_page_cost_the_least():
    page = read_page(f"<div><p>{PROSE}</p><p>{SHORT}</p></div><div><a>x</a><p>y</p></div>")
    assert content_blocks(page, ODDS) == [True, True, False, False]
