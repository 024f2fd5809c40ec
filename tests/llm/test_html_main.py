"""Main texts against the article elements of the given pages, and hand-written pages."""

import random
import re
from collections import Counter
from html import unescape

import pytest
from pricebasket.llm import html_main
from pyspark.sql import functions as F


def article(html):
    inner = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    blocks = re.split(r"</?(?:p|h1|br)\b[^>]*>", inner)
    lines = (" ".join(unescape(re.sub(r"<[^>]*>", "", block)).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


@pytest.fixture(scope="module")
def pages(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


@pytest.fixture(scope="module")
def weights(pages):
    return html_main.train(pages)


def test_given_pages(pages):
    expected = {r["page_id"]: (r["url"], article(r["html"])) for r in pages.collect()}
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in html_main.extract(pages).collect()}
    assert got == {key: (url, text, len(text)) for key, (url, text) in expected.items()}


def test_without_labels(pages):
    """Pages whose article element is a plain one are extracted by the weights of others."""
    plain = pages.withColumn("html", F.regexp_replace("html", "<(/?)article>", "<$1div>"))
    expected = {r["page_id"]: article(r["html"]) for r in pages.collect()}
    weights = html_main.train(pages)
    right = [html_main.main_text(r["html"], weights) == expected[r["page_id"]] for r in plain.collect()]
    assert sum(right) > 0.95 * len(right)


SOUP = """<html><head><title>Title words</title><style>p{}</style></head><body><header><p>Site name here</p></header>
<nav><ul><li><a href='/x'>One<li><a>Two</ul></nav><div class="cookie-notice"><p>We use cookies a lot, agree please now</p></div>
<article><h1>Head &amp; line</h1><p>First   paragraph&nbsp;with <b>bold</b>ness
 and <i>more</i> words.<!-- <p>gone</p> --><p>Second &lt;one&gt; <script>var x = "<p>no</p>";</script>is here
<aside><p>Read also this and that</p></aside><div class="ad"><p>Buy this now, buy this now</p></div>
<ul><li>item one of a list that goes on<li>item two of it as well</ul><form><label>Mail</label><button>Send</button></form></article>
<section id="comments"><h2>Comments</h2><p>I liked it very much indeed, thanks for all the words</p></section>
<footer>&copy; somebody</footer></body></html>"""


def test_parts_of_a_page(weights):
    assert html_main.main_text(SOUP, weights) == (
        "Head & line\nFirst paragraph with boldness and more words.\nSecond <one> is here\nitem one of a list that goes on\nitem two of it as well")


@pytest.mark.parametrize("html", [None, "", " ", "<p></p>", "<nav><a>menu</a></nav>", "<script>never ends <p>x", "<!-- open"])
def test_nothing_to_find(weights, html):
    assert html_main.main_text(html, weights) == ""


@pytest.mark.parametrize("html, text", [
    ("plain text only", "plain text only"), ("<p>a < b and c</p>", "a < b and c"), ("</div></p><p>stray ends</b></p>", "stray ends"),
    ("<P CLASS=x>Upper<BR/>case</P>", "Upper\ncase"), ('<p title="a>b">quoted end</p>', "quoted end"),
    ("<p>" + "word " * 50_000, ("word " * 50_000).strip()), ("<b>" * 3000 + "deep words", "deep words"),
])
def test_broken_markup(weights, html, text):
    assert html_main.main_text(html, weights) == text


def test_weights_are_counts_of_distinct_pages(pages):
    """Copies of pages change nothing, wherever they lie; a bound takes whole pages of least hash."""
    plain = Counter()
    for r in pages.collect():
        if re.search(r"<(?:article|main)[\s>]", r["html"].lower()):
            plain.update(html_main.counted(r["html"]))
    expected = {kind: (plain[kind, True], plain[kind, False]) for kind, _ in plain}
    assert html_main.train(pages).counts == expected
    assert html_main.train(pages.unionByName(pages).repartition(7)).counts == expected
    few = [html_main.train(some, 5).counts for some in (pages, pages.unionByName(pages).repartition(3))]
    assert few[0] == few[1] and sum(map(sum, few[0].values())) < sum(map(sum, expected.values()))


def best_run(scores):
    """The greatest sum of all runs, each added up."""
    return max((sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=0.0)


@pytest.mark.parametrize("seed", range(20))
def test_the_scan_finds_the_best_run(seed):
    """The words between random tags, against all runs; weights are such that no word inside a run is put out."""
    draw = random.Random(seed)
    shares = {f"div.{name}": draw.choice([0.35, 0.6, 1.0]) for name in "abcd"} | {"hr": 0.0, "br": 0.4}
    weights = html_main.Weights({})
    weights._known = dict(shares)
    html, words = "", 0
    for _ in range(draw.randint(1, 25)):
        if draw.random() < 0.5:
            html += draw.choice(["<hr>", "<br>", "<hr><hr><br>"])
        else:
            n = draw.randint(1, 3)
            html += f"<div class={draw.choice('abcd')}>{' '.join(f'w{words + k}' for k in range(n))}</div>"
            words += n
    pieces = list(html_main.parts(html))
    scores = [weights.word(p.open) * len(p.text.split()) if p.text else -html_main.STEP - html_main.COST * (1 - weights.share(p.kind)) for p in pieces]
    got = html_main.main_text(html, weights).split()
    best = best_run(scores)
    if best < html_main.ENOUGH:
        assert got == []
        return
    all_words = [word for p in pieces if p.text for word in p.text.split()]
    at = all_words.index(got[0])
    assert got == all_words[at : at + len(got)]
    holds = [i for i, p in enumerate(pieces) if p.text and set(p.text.split()) & set(got)]
    assert max(sum(scores[a : b + 1]) for a in range(holds[0] + 1) for b in range(holds[-1], len(scores))) == pytest.approx(best)


def test_odd_rows(spark, pages):
    rows = [(1, "u", None), (1, "u", ""), (None, None, SOUP), (2, "v", "<article>x y z</article>")]
    odd = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("c"), "n_chars": F.lit(1)})
    got = html_main.extract(odd).collect()
    assert sorted((str(r["page_id"]), len(r["text"]) == r["n_chars"], bool(r["text"])) for r in got) == [
        ("1", True, False), ("1", True, False), ("2", True, True), ("None", True, True)]
    assert html_main.extract(pages.limit(0)).collect() == []
