from __future__ import annotations

import html
import itertools
import re

import numpy as np
import pytest

from medallion.llm import html_extraction
from medallion.llm.html_blocks import blocks
from medallion.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
<body><nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site.</p><button>OK</button></div><!-- <p>not this</p> -->
<article><h1>Big &amp; bold</h1><p>First   paragraph,
with <a href="x>y">a link</a> and&nbsp;more.<p>Second one <br>goes on. <div class="ad">Buy this thing now.</div>
<ul><li>One item here<li>Another item</ul></article>
<section class="comments"><h2>Comments</h2><div class="comment"><p>I liked this article a lot.</p></div></section>
<form><label>Mail</label><input><button>Subscribe</button></form>
<footer>&copy; 2024 example.com</footer></body></html>"""


@pytest.fixture(scope="module")
def field():
    return html_extraction.trained()


def test_main_text(field):
    assert field.main_text(PAGE).split("\n\n") == [
        "Big & bold",
        "First paragraph, with a link and more.",
        "Second one goes on.",
        "One item here",
        "Another item",
    ]


def test_blocks_of_broken_pages():
    assert [b.text for b in blocks("plain text < 3 and &lt;b&gt;")] == ["plain text < 3 and <b>"]
    assert [b.text for b in blocks("<p>a<div>b</p>c</div></div></x><p>d")] == ["a", "b", "c", "d"]
    assert [b.text for b in blocks("<script>never ends <p>x")] == []
    assert [b.text for b in blocks("a<!-- never ends <p>x")] == ["a"]
    assert blocks("") == [] and blocks("<p> &nbsp; </p>") == []


def test_held_out_pages(field):
    wrong = total = 0
    for page, labels in html_extraction.labelled_pages(200, seed=99):
        wrong += sum(a != b for a, b in zip(field.decode(page), labels, strict=True))
        total += len(labels)
    assert wrong <= 0.01 * total


def test_viterbi_against_all_labellings(field):
    page = blocks(PAGE)[:8]
    scores = field.scores(page)

    def score(labels):
        moves = sum(field.moves[a, b] for a, b in itertools.pairwise(labels))
        return field.start[labels[0]] + moves + sum(scores[i, label] for i, label in enumerate(labels))

    best = max(itertools.product((0, 1), repeat=len(page)), key=score)
    assert field.decode(page) == list(best)


def test_marginals_against_all_labellings():
    draw = np.random.default_rng(3)
    scores, moves = draw.normal(size=(1, 5, 2)), draw.normal(size=(2, 2))
    mask = np.ones((1, 5), bool)
    mask[0, 4] = False
    single, double = html_extraction._marginals(scores, moves, mask)
    weights = {}
    for labels in itertools.product((0, 1), repeat=4):
        total = sum(scores[0, i, label] for i, label in enumerate(labels))
        weights[labels] = np.exp(total + sum(moves[a, b] for a, b in itertools.pairwise(labels)))
    norm = sum(weights.values())
    for i in range(4):
        assert single[0, i, 1] == pytest.approx(sum(w for x, w in weights.items() if x[i]) / norm)
    pairs = sum(w for x, w in weights.items() for a, b in itertools.pairwise(x) if (a, b) == (0, 1))
    assert double[0, 1] == pytest.approx(pairs / norm)


def test_odd_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "", ""), (1, "u", PAGE), (None, "v", "<nav>x</nav>")]
    rows.append((4, "w", "<article>" + "<p>Some words, and more. " * 20_000 + "</article>"))
    schema = "page_id bigint, url string, html string, text string, n_chars string"
    pages = spark.createDataFrame([(*r, "x", "x") for r in rows], schema)
    found = html_extraction.extract(pages).collect()
    assert len(found) == len(rows)
    by = {r["page_id"]: r for r in found}
    assert by[2]["text"] == by[3]["text"] == "" and by[2]["url"] is None and by[2]["n_chars"] == 0
    assert by[4]["text"].count("\n\n") == 19_999
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html_extraction.extract(pages.limit(0)).count() == 0


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    found = {r["page_id"]: r["text"] for r in QUERIES["op5_html_extraction"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    right = 0
    for r in pages:
        inside = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        parts = [re.sub(r"</?b>", "", x).replace("<br>", " ") for x in re.split(r"</?(?:p|h1)>", inside)]
        texts = [" ".join(html.unescape(x).split()) for x in parts]
        right += found[r["page_id"]] == "\n\n".join(t for t in texts if t)
    assert len(found) == len(pages) and right >= 0.98 * len(pages)


def test_nothing_is_lost_after_empty_elements_formulas_and_open_heads():
    texts = lambda page: [b.text for b in blocks(page)]
    assert texts('<p>one</p><svg class="i"/><p>two</p>') == ["one", "two"]
    assert texts("<p>one</p><math/><p>two</p>") == ["one", "two"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>") == ["so x=1 holds"]
    assert texts("<p>a<svg><text>no</text></svg>b") == ["a b"]
    for name in ("svg-icon", "template-part", "select-menu", "script-note", "object1", "style.x", "iframe:x"):
        assert texts(f"<p>one</p><{name}></{name}><p>two</p>") == ["one", "two"]
        assert texts(f"<p>one</p><{name} class='x'>in</{name}><p>two</p>") == ["one", "in", "two"]
    assert texts("<p>one</p><svg/><script>no</script ><style\n>no</style><p>two</p>") == ["one", "two"]
    assert texts("<head><title>T</title><meta charset=x><p>one</p><p>two <b>three</b></p>") == ["one", "two three"]
    assert texts("<html><head><title>T</title><link rel=x>plain<p>one") == ["plain", "one"]
