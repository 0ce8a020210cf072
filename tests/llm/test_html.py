import random
import time
from itertools import product

import pytest

from quarry.llm.html_text import extract_main_text, main_text, source_side

PAGE = """<!DOCTYPE html><html><head><title>t &amp; t</title><style>p{}</style><script>var t="</p><p>no";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href="a">One</a><li><a href="b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept them, please, now.</div><!-- ad -->
<main><h1>Title  of\nit</h1><p><b>First</b> para, with <a href=x>a link</a> in it &amp; more.<br>Next line.<p>Second&nbsp;para &lt;x&gt;.
<div class=ad>Buy now!</div><p>Third short.</p><ul><li>point a<li>point b</ul></main>
<aside class="sidebar"><h3>Related</h3><p>Another story is here. It is long, and has commas, and more of them.</p></aside>
<section id="comments"><h2>Comments</h2><p>Nice post, I liked it, very much so. A really long comment here with words.</p></section>
<form><label>Mail</label><input name=q><button>Go</button></form><footer><p>&copy; 2024 Company.</p></footer></body></html>"""


def test_page():
    want = ["Title of it", "First para, with a link in it & more. Next line.", "Second para <x>.", "Third short.", "point a", "point b"]
    assert main_text(PAGE).split("\n") == want


def test_minimum_cut_against_all_labellings():
    rnd = random.Random(6)
    for _ in range(200):
        n = rnd.randint(1, 8)
        costs = [rnd.uniform(-3, 3) for _ in range(n)]
        edges = [(i, j, rnd.uniform(0, 2)) for i in range(n) for j in range(i) if rnd.random() < 0.5]

        def total(labels, costs=costs, edges=edges):
            own = sum(max(c, 0) if not keep else max(-c, 0) for c, keep in zip(costs, labels, strict=True))
            return own + sum(w for i, j, w in edges if labels[i] != labels[j])

        best = min(total(labels) for labels in product([False, True], repeat=n))
        assert abs(total(source_side(costs, edges)) - best) < 1e-6


def test_minimum_cut_of_a_long_chain():
    """Against the exact dynamic program over a chain; costs too small to settle nodes by themselves."""
    rnd = random.Random(7)
    n = 60_000
    costs = [rnd.choice([-0.3, 0.3, 0.025, -0.025, 0.0]) for _ in range(n)]
    weights = [rnd.choice([0.25, 0.5, 1.25]) for _ in range(n - 1)]
    out, into = max(costs[0], 0), max(-costs[0], 0)  # least cost so far with the last node out of or in the content
    for c, w in zip(costs[1:], weights, strict=True):
        out, into = min(out, into + w) + max(c, 0), min(into, out + w) + max(-c, 0)
    start = time.perf_counter()
    side = source_side(costs, [(i, i + 1, w) for i, w in enumerate(weights)])
    total = sum(max(-c, 0) if s else max(c, 0) for c, s in zip(costs, side, strict=True))
    total += sum(w for a, b, w in zip(side, side[1:], weights) if a != b)
    assert abs(total - min(out, into)) < 1e-3
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize(
    "page",
    [
        "<p>Some short text here.</p><a href=x>link</a>" * 40_000,
        "<div>" * 40_000 + "</section>text, more. <span>" * 40_000,
        "<p><article>" + "<div>a b c.</p>" * 60_000,
        "<span>" * 30_000 + "<p>x y.</p>tail text, of it" * 30_000,
        "<div class=content><p>one. two</p>text in it<p>x</p>" * 20_000 + "</div>" * 20_000,
    ],
)
def test_long_pages_take_linear_time(page):
    start = time.perf_counter()
    main_text(page)
    assert time.perf_counter() - start < 20


#: (page, the article's text as its writer meant it)
LABELLED = [
    ("<body><div id=top-bar><a href=/>Site</a> <a href=/x>News</a></div><article><header><h1>A walk</h1></header><p>We went out early, and came back late.</p>"
     "<p>It rained.</p></article><div class=related><h3>More</h3><a href=1>One</a></div></body>", ["A walk", "We went out early, and came back late.", "It rained."]),
    ("<body><div class='post-body'><h2>Bread</h2><p>Mix flour and water. Wait an hour, or two.</p><blockquote>Patience is all.</blockquote>"
     "<table><tr><td>Flour, 500 g.</td></tr></table></div><div class=comments><p>Great recipe, thank you, I made it twice.</p></div></body>",
     ["Bread", "Mix flour and water. Wait an hour, or two.", "Patience is all.", "Flour, 500 g."]),
    ("<body><nav><a href=a>A</a></nav><main><p>Only one sentence stands here, and that is all.</p></main><aside><p>Sponsored: buy a car, now, cheaply.</p></aside>"
     "<footer>All rights reserved</footer></body>", ["Only one sentence stands here, and that is all."]),
    ("<body><nav><a href=a>A</a></nav><form><label>Name</label><button>Send</button></form><footer><p>Imprint</p></footer></body>", []),
]


@pytest.mark.parametrize(("page", "want"), LABELLED)
def test_labelled_pages(page, want):
    assert main_text(page) == "\n".join(want)


@pytest.mark.parametrize("page", ["", "<", "<p", "<!--", "</p></div>", "&amp", "<script>x", "<div>" * 3000 + "deep, text.", "<p>" + "long words " * 60_000])
def test_broken_pages(page):
    main_text(page)


def test_frame(spark):
    rows = [(1, "u", PAGE, "clash"), (1, "u", PAGE, "clash"), (2, None, None, None), (3, "v", "", "x"), (None, "w", "plain &lt;text&gt;", "x"), (4, "y", "<p>É 🙂</p>", "z")]
    got = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted([(i, u, main_text(h or ""), len(main_text(h or ""))) for i, u, h, _ in rows], key=repr)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_main_text(empty).collect() == []
