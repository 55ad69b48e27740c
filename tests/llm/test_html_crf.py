"""DOM blocks, Viterbi against enumeration, and pages of known main text."""

import html
import itertools
import random
import re

import pytest

from candlewick.llm import html_crf as H
from candlewick.llm.common import prepare

DIR = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in H.blocks_of(page)]


def test_blocks_of_odd_markup():
    assert texts(None) == texts("") == texts("<p></p> \n") == []
    assert texts("<p>a &amp; b&nbsp;c<br>d\n <b>e</b>f<p>g<div>h</div>i") == ["a & b c d ef", "g", "h", "i"]
    assert texts("x<!-- <p>no</p> -->y<script>var a='</p>'</script>z<style>q</style><textarea>t</textarea>") == ["xyz"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == ["a", "b", "c", "d", "e"]
    assert texts('<p title="a > b">1 < 2 &lt; 3</p></article></b>4<p') == ["1 < 2 < 3", "4"]
    assert texts("<!DOCTYPE html><title>t</title><p>a<!-- open") == ["a"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>") == ["a", "b", "c"]
    assert len(texts("<p>" * 50_000 + "x")) == 1 and len(H.blocks_of("<div>" * 3000 + "x")[0].path) == 3000


def test_paths_names_and_links():
    b, = H.blocks_of("<article id='Main-Post'><div class='ad box'><p><a href=x>abc</a> d</article>")
    assert [t for t, _ in b.path] == ["article", "div", "p"] and b.path[1][1] == ("ad", "box")
    assert b.path[0][1] == ("main", "post") and b.linked == pytest.approx(3 / 5)


@pytest.mark.parametrize("seed", range(30))
def test_viterbi_is_the_best_of_all_labellings(seed):
    rng = random.Random(seed)
    names = [f"f{i}" for i in range(5)]
    m = H.Crf({x: rng.uniform(-2, 2) for x in names}, (rng.random(), rng.random()),
              tuple(tuple(rng.uniform(-2, 2) for _ in "ab") for _ in "ab"))
    page = [rng.sample(names, rng.randint(0, 3)) for _ in range(rng.randint(1, 8))]

    def score(y):
        return (m.start[y[0]] + sum(m.step[a][b] for a, b in zip(y, y[1:]))
                + sum(sum(m.weight[x] for x in f) for f, k in zip(page, y) if k))

    best = max(itertools.product((0, 1), repeat=len(page)), key=score)
    assert score(m.viterbi(page)) == pytest.approx(score(best)) and m.viterbi([]) == []


@pytest.fixture(scope="module")
def model(spark):
    prepare(spark)
    return H.fit(spark.read.parquet(f"{DIR}/pages.parquet"))


def article(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    parts = (re.sub(r"\s+", " ", html.unescape(re.sub("<[^>]+>", " ", x))).strip() for x in re.split("</?(?:p|h1)>", inner))
    return "\n".join(x for x in parts if x)


def test_articles_of_all_pages(spark, model):
    pages = spark.read.parquet(f"{DIR}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = H.main_text(pages, model).collect()
    assert sum(r.text == want[r.page_id] for r in got) >= 0.99 * len(want) and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


def test_held_out_layouts(model):
    rng = random.Random(77)
    right = total = 0
    for _ in range(150):
        page, labels = H.training_page(rng, ["Some words that make a sentence here.", "Another, longer one it is; yes."] * 3)
        got = model.viterbi(H.features(H.blocks_of(page)))
        assert len(got) == len(labels)
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total >= 0.97


def test_regions_that_are_not_the_article(model):
    page = """<body><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies on it.</p></div>
     <article><h1>Title of it</h1><p>First paragraph of the story, with words.</p><div class="advert">Buy this now.</div>
     <p>Second paragraph &amp; more.</p><form><p>Sign up for our letter.</p></form></article>
     <aside><p>Sidebar text stands here.</p></aside><section id="comments"><h3>Comments</h3><p>I liked this story a lot.</p></section>
     <footer>&copy; Site</footer></body>"""
    assert H.extract(model, page) == "Title of it\nFirst paragraph of the story, with words.\nSecond paragraph & more."


def test_defined_cases(spark, model):
    long = "<article>" + "<p>A sentence of words.</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "", 2), (2, "u", long, 3)],
                               "page_id bigint, url string, html string, text int")
    got = H.main_text(df, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(r.n_chars for r in got.collect()) == [0, 0, 0, 21 * 20_000 - 1]
    assert H.main_text(df.limit(0), model).collect() == []
    assert H.fit(df.limit(0)).weight


def test_the_sample_is_bounded_and_never_empty(spark):
    """Ids that say nothing: all rows of one id, or of none, and one page repeated."""
    prepare(spark)
    for page_id in (None, 1, 2, 3):
        rows = [(page_id, f"<p>text {i}</p>") for i in range(300)] + [(page_id, "<p>again</p>")] * 300 + [(page_id, "")] * 300
        df = spark.createDataFrame(rows, "page_id bigint, html string").repartition(4)
        got = H.sample_texts(df, 5)
        assert len(got) == len(set(got)) == 5 and all(x.startswith(("text", "again")) for x in got)
        assert got == H.sample_texts(df.repartition(2), 5)
    assert len(H.sample_texts(df, 1000)) == 301


@pytest.mark.parametrize("page,texts", [
    ('<p>a</p><svg class="i"/><p>kept</p>', ["a", "kept"]),
    ('<p>a</p><svg class="i"><text>no</text><p>kept</p>', ["a", "no", "kept"]),
    ('<p>a</p><svg><g><svg/><svg>no</svg>no</g></svg><p>kept</p>', ["a", "kept"]),
    ("<p><a onclick=don't>link</a> more</p>", ["link more"]),
    ('<p title=a"b>one</p><p title="a>b" x=\'c>d\'>two</p><p a"b>three</p>', ["one", "two", "three"]),
    ("<template>x<template>y</template>no</template><p>kept</p>", ["kept"]),
    ("<template><p>kept</p>", ["kept"]),
    ("<noscript><p>kept", ["kept"]),
    ("<p>a</p><script>if (a < b) '<p>no</p>'</script><p>kept</p><script>var open = 1", ["a", "kept"]),
])
def test_tags_end_where_html_ends_them(page, texts):
    assert [b.text for b in H.blocks_of(page)] == texts
