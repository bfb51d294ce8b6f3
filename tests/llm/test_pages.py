import html
import itertools
import re
import time

import numpy as np
import pytest

from tallyloom.llm import pages


@pytest.fixture(scope="module")
def model():
    return pages.train([pages.parse(p, labelled=True) for p in pages.labelled_pages()])


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    dom = pages.parse("<html><body><div class=ad><p>one</p></div><article><p>two<p>three</article></body></html>")
    model = pages.Model(rng.normal(size=(pages.N_ELEMENT + pages.N_TEXT, pages.STATES)), rng.normal(size=(2, pages.STATES, pages.STATES)))
    forest = pages.Forest([dom])
    p, _ = pages.marginals(model, forest)
    n = len(dom.parent)
    unary = np.zeros((n, pages.STATES))
    np.add.at(unary, forest.owner, model.weights[forest.feature])
    total = np.zeros((n, pages.STATES))
    for states in itertools.product(range(pages.STATES), repeat=n):
        w = np.exp(sum(unary[i, s] for i, s in enumerate(states))
                   + sum(model.edges[int(dom.leaf[i]), states[dom.parent[i]], s] for i, s in enumerate(states) if dom.parent[i] >= 0))
        for i, s in enumerate(states):
            total[i, s] += w
    assert np.allclose(p, total / total.sum(1, keepdims=True))


def test_articles_of_the_table(spark, model):
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if "<br>" in b else "", b)).split()) for b in re.split(r"</?p>|</?h1>", article))
        assert pages.extract(model, [r.html]) == ["\n".join(b for b in blocks if b)]


LAYOUTS = [
    ("<body><nav><a href=x>Home</a></nav><main><h1>Head line</h1><p>First &amp; only\n  part.</p><ul><li>a</li><li>b</li></ul></main>"
     "<section class='comments'><p>I disagree with all of this text here.</p></section></body>", "Head line\nFirst & only part.\na\nb"),
    ("<div id=header><p>Site name</p></div><div class='post-content'><p>One<p>Two<br>three</div><div class='sidebar'><p>Read more</p></div>"
     "<div class='cookie-notice'><p>We use cookies.</p></div><form><label>Name</label><p>Send us mail</p></form>", "One\nTwo three"),
    ("<article><h2>T</h2><div class=ad><p>Buy now</p></div><p>x &lt; y</p><script>if (a < b) { '</p>' }</script><aside>See also</aside><blockquote>q</blockquote>", "T\nx < y\nq"),
]


@pytest.mark.parametrize("page, want", LAYOUTS)
def test_other_layouts(model, page, want):
    assert pages.extract(model, [page]) == [want]


UNENDED = [
    "<html><head><title>x</title><body><article><p>One</p><p>Two</p></article></body></html>",
    "<html><head><title>x</title><meta charset=utf-8><style>p {}</style><article><p>One</p><p>Two</p></article></html>",
    "<head><title>x</title><script>'<p>'</script></head><body><article><p>One</p><video src=v><source src=w><p>Two</p></article>",
    "<article><p>One</p><select><option>a<option>b<p>Two</p></article>",
    "<article><p>One</p><object data=o><param name=n><p>Two</p></article>",
    "<article><p>One</p><svg><g><path d=p /><p>Two</p><svg><text>no</text></svg></article>",
    "<article><p>One</p><audio src=a><!-- </audio> --><p>Two</p><audio><p>fallback</p></audio></article>",
    "<article><p>One</p><noscript><template><p>Two</p></article>",
]


@pytest.mark.parametrize("page", UNENDED)
def test_hidden_elements_without_an_end(model, page):
    assert pages.extract(model, [page]) == ["One\nTwo"]


TWO = "<p>The first of them has a good many words, and it ends as sentences do.</p><p>So does the second one, which is not short either; it says more.</p>"
SAID = "The first of them has a good many words, and it ends as sentences do.\nSo does the second one, which is not short either; it says more."
UNMARKED = [
    f'<html><body><nav><a href=x>Home</a></nav><div class="c-12"><div class="x9">{TWO}</div></div><footer>Legal notes</footer></body></html>',
    f"<html><body><header><h1>Site</h1></header><div>{TWO}</div><footer><p>All rights are reserved by the owners of this site.</p></footer></body></html>",
    f'<html><body><article>{TWO}</article><article class="comment"><p>I do not agree with what is said above, not at all.</p></article></body></html>',
    f'<html><body><div class="row"><div class="c1">{TWO}</div><div class="c2"><a href=x>More</a> <a href=y>News</a></div></div></body></html>',
]


@pytest.mark.parametrize("page", UNMARKED)
def test_text_in_unmarked_boxes(model, page):
    assert pages.extract(model, [page]) == [SAID]


def test_links_and_headings_of_an_article(model):
    page = f"<html><body><article><header><h1>What they say</h1></header>{TWO}<p><a href=x>The whole report can be read here.</a></p></article></body></html>"
    assert pages.extract(model, [page]) == [f"What they say\n{SAID}\nThe whole report can be read here."]


@pytest.mark.parametrize("page", ["<div>" * 60_000 + "x", "<b>" * 20_000 + "</i></div>" * 20_000 + "x", "<div>" * 20_000 + "<li>x" * 20_000, "<select>" * 5_000 + "<p>x" * 20_000,
                                  "<svg>" * 20_000 + "<p>y</p>" * 20_000 + "</svg>" * 20_000 + "x", "<p><table>" * 10_000 + "<p>x" * 10_000])
def test_parsing_takes_time_in_proportion(page):
    start = time.process_time()
    assert any("x" in t for t in pages.parse(page).text)
    assert time.process_time() - start < 5


def test_text_ends_the_head():
    assert pages.parse("<head><title>x</title>Straight text").text[-1] == "Straight text"


def test_held_out_pages(model):
    forest = pages.Forest([pages.parse(p, labelled=True) for p in pages.labelled_pages(150, seed=99)])
    p, _ = pages.marginals(model, forest)
    assert ((p[:, 1] > 0.5) == (forest.label == 1))[forest.leaf].mean() > 0.93


def test_awkward_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p"), (None, "u", "<article>" + "<div>" * 3000 + "deep"), (5, "u", "a<b <3 & &unknown; </nope><!-- x"),
            (6, "u", "<article>" + "<p>long text</p>" * 5000 + "</article>"), (6, "u", "<article><p>twice</p></article>")]
    frame = spark.createDataFrame([r + ("x", "y") for r in rows], "page_id bigint, url string, html string, text string, row string")
    found = {(r.page_id, len(r.text)): r.text for r in pages.main_text(frame).collect()}
    assert len(found) == 7 and found[(1, 0)] == found[(2, 0)] == ""
    assert (6, 5000 * 10 - 1) in found and (6, 5) in found
    assert pages.main_text(frame.limit(0)).collect() == []
