import random
import re
import time
from collections import Counter

import pytest

from waybill.llm.labelled_pages import labelled_pages
from waybill.llm.main_text import CONTENT, Markup, forest, learnt_model, main_texts, parsed

PAGES = "page_id long, url string, html string"


@pytest.fixture(scope="module")
def model(spark):
    return learnt_model(labelled_pages(spark, 600))


def texts(spark, model, *htmls):
    rows = spark.createDataFrame([(i, "u", h) for i, h in enumerate(htmls)], PAGES).selectExpr("*", "'x' AS text", "1 AS n_chars")
    got = {r.page_id: r for r in main_texts(rows, model).collect()}
    assert all(r.n_chars == len(r.text) for r in got.values())
    return [got[i].text for i in range(len(htmls))]


def test_an_article_among_other_things(spark, model):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>
    <div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div><!-- <p>no</p> -->
    <article><h1>Fish &amp; chips&nbsp;&#39;n more</h1><p><b>Bold start<br>next<p>Second   paragraph of
    some words, &lt;b&gt; and so on.<div class="ad">Buy now.</div><ul><li>first item of it<li>second item of it</ul></article>
    <section class="comments"><p>Great text, I liked it a lot.</p></section><form><label>Search</label><input></form>
    <aside class="sidebar"><p>Related things to read.</p></aside><footer>&copy; someone</footer></body></html>"""
    assert texts(spark, model, page) == [
        "Fish & chips 'n more\nBold start next\nSecond paragraph of some words, <b> and so on.\nfirst item of it\nsecond item of it"
    ]


def test_odd_pages(spark, model):
    odd = texts(spark, model, None, "", "   ", "</p></div>", "<script>only", "<!-- open", "<nav></nav>", "<title>x", "<!")
    assert odd == [""] * 9
    long = "<article>" + "<p>Some words in a row.</p>" * 20_000 + "</article>"
    deep = "<div>" * 3000 + "<p>deep down here are words.</p>"
    out = texts(spark, model, long, deep, None, "")
    assert out[0].count("\n") == 19_999 and out[2:] == ["", ""]


def test_marginals_are_those_of_the_whole_tree(model):
    import itertools

    import numpy as np

    from waybill.llm.main_text import subtree_features

    page = parsed("<div class=content><p>Some words here.</p></div><nav><a>x</a></nav>")
    trees = forest([page])
    local = [sum(model.emission[model.rows[f]] for f in fs if f in model.rows) + np.zeros(3) for fs in subtree_features(trees)]
    total = np.zeros((len(local), 3))
    for states in itertools.product(range(3), repeat=len(local)):
        log = model.root[states[0]] + sum(local[i][s] for i, s in enumerate(states))
        log += sum(model.edge[states[p], states[i]] for i, p in enumerate(page.parent) if p >= 0)
        for i, s in enumerate(states):
            total[i, s] += np.exp(log)
    assert np.allclose(model.marginals(trees), total / total.sum(axis=1, keepdims=True))


def test_pages_of_other_seeds(spark, model):
    held = labelled_pages(spark, 200, seed=77).toPandas()
    got = texts(spark, model, *held.html)
    found = right = wanted = 0
    for text, expected in zip(got, held.text):
        a, b = Counter(expected.split("\n")), Counter(text.split("\n"))
        right, found, wanted = right + (a & b).total(), found + b.total(), wanted + a.total()
    assert right / found > 0.97 and right / wanted > 0.97


def test_structure_of_broken_markup():
    page = parsed("<table><tr><td>a<td>b<tr><td>c</table><ul><li>x<ul><li>y</ul><li>z</ul><p>1<h2>2</h2>3")
    runs = [(r, page.features[p][0]) for r, p in zip(page.run, page.parent) if r]
    assert runs == [
        ("a", "tag td"), ("b", "tag td"), ("c", "tag td"), ("x", "tag li"), ("y", "tag li"), ("z", "tag li"),
        ("1", "tag p"), ("2", "tag h2"), ("3", "tag page"),
    ]
    assert CONTENT == 1


def test_empty_table(spark, model):
    assert main_texts(spark.createDataFrame([], PAGES), model).count() == 0


@pytest.mark.parametrize(
    "html",
    ["<a " * 350_000, "<" + "a" * 1_000_000, "<a<a" * 250_000 + ' "', '<a "x>" ' * 120_000 + "'", "<a '" * 200_000 + ">", "</a " * 250_000, "<!--" * 250_000],
)
def test_broken_markup_of_a_million_characters_is_read_in_time(html):
    start = time.perf_counter()
    parsed(html)
    assert time.perf_counter() - start < 5


def test_tags_are_found_as_one_pattern_would():
    pattern = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*+(?:"[^"]*"|'[^']*'|[^'">])*>""", re.S)
    draw = random.Random(4)
    parts = ["<a ", "<", ">", '"', "'", "<p>", "</p>", "x", '<b class="q>">', " ", "</", "<!--", "-->", "<1", "< a>", "<br/>", "<i t='>'>"]
    for _ in range(4000):
        html = "".join(draw.choice(parts) for _ in range(draw.randint(0, 25)))
        markup, at, got = Markup(html), 0, []
        while match := markup.next(at):
            got.append(match.span())
            at = match.end()
        assert got == [m.span() for m in pattern.finditer(html)], html
