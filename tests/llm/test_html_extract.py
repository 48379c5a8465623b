"""Main-text extraction: reading of HTML, the chain's inference against
enumeration, held-out pages, and the given table against its own markup."""

import html
import itertools
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from surgecast.llm import html_extract as H
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def model():
    return H.fit()


def texts(page):
    return [b.text for b in H.leaf_blocks(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", []),
        ("plain  \n text", ["plain text"]),
        ("<p>a<p>b<div>c</div>d", ["a", "b", "c", "d"]),
        ("<p><b>one<br><p>two</b> x</p>", ["one", "two x"]),
        ("a<script>var x = '</p>';</script>b<style>p{}</style>c", ["abc"]),
        ("a<!-- <p>no</p> -->b<!-->c<!doctype x>d<?y?>e", ["abcde"]),
        ("x &amp;&lt;&eacute;&#233;&nbsp;y", ["x &<éé y"]),
        ("1 < 2 <3 a<", ["1 < 2 <3 a<"]),
        ('<a title="x > y" href=z>l</a><img alt=\'<p>\'>m', ["lm"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]),
        ("a<script>never closed <p>b", ["a"]),
        ("a<!-- never closed <p>b", ["a"]),
        ('a<p class="never closed>b', ["a", "b"]),
        ('a<p class="never closed', ["a"]),
        ("<head><title>t</title></head><body>x<textarea>y</textarea></body>", ["x"]),
        ("</p></div></b>text</article>", ["text"]),
    ],
)
def test_reading(page, want):
    assert texts(page) == want


def test_places():
    page = "<nav><a href=x>n</a></nav><main><article class='post entry'><p>t<aside>s</aside><p>u</article></main>"
    blocks = H.leaf_blocks(page)
    assert [b.text for b in blocks] == ["n", "t", "s", "u"]
    assert blocks[0].linked == 1 and blocks[1].linked == 0
    assert "in main>article" in blocks[1].place and "word entry" in blocks[1].place
    assert "in article>aside" in blocks[2].place and "under main" in blocks[2].place
    assert "inner article" in blocks[3].place


def test_reading_is_linear():
    """Pages made to be slow: two million characters each."""
    n = 200_000
    for page in ("<" * n * 5, "<a " * n, '<a x="' * n, "<div>" * n + "x", "<b>" * n + "</b>" * n, "<li>" * n, "<!--" * n, "<x1 a='\">" * n, "&" * n * 5, "<p>x" * n):
        began = time.process_time()
        H.leaf_blocks(page)
        assert time.process_time() - began < 20


def test_inference_equals_enumeration():
    rng = np.random.default_rng(1)
    crf = H.BlockCrf()
    crf.start, crf.switch = rng.normal(size=2), rng.normal(size=(2, 2))
    counts = np.array([3, 0, 1, 5, 2])
    e = rng.normal(size=(counts.sum(), 2))
    chain = H.Chain(counts)
    marginal, starts, pairs = crf.marginals(e, chain)
    label = crf.viterbi(e, chain)
    at, want_pairs, want_starts = 0, np.zeros((2, 2)), np.zeros(2)
    for n in counts:
        if not n:
            continue
        paths = list(itertools.product((0, 1), repeat=int(n)))
        score = [crf.start[p[0]] + sum(e[at + i, y] for i, y in enumerate(p)) + sum(crf.switch[a, b] for a, b in zip(p, p[1:])) for p in paths]
        weight = np.exp(score) / np.exp(score).sum()
        for i in range(n):
            assert marginal[at + i, 1] == pytest.approx(sum(w for w, p in zip(weight, paths) if p[i]))
        for w, p in zip(weight, paths):
            want_starts[p[0]] += w
            for a, b in zip(p, p[1:]):
                want_pairs[a, b] += w
        assert tuple(label[at : at + n]) == paths[int(np.argmax(score))]
        at += n
    assert np.allclose(pairs, want_pairs) and np.allclose(starts, want_starts)


def test_held_out_pages(model):
    wrong = total = 0
    for seed in range(10**6, 10**6 + 200):
        blocks, labels = H.labelled(H.labelled_page(seed))
        if blocks:
            ids, first, chain = H._flat([blocks])
            wrong += int((model.viterbi(model.emissions(ids, first), chain) != np.array(labels)).sum())
            total += len(labels)
    assert total > 5000 and wrong / total < 0.01


UNSEEN = """<html><body><div id="cookieNotice" class="gdpr-bar"><p>We use cookies, as all do.</p><button>OK</button></div>
<header class="site-head"><h1>My Site</h1><nav><a href=/>Home</a> <a href=/b>About</a></nav></header>
<main><article><h1>A fine title</h1><p>First paragraph of the story, with some words in it.</p>
<div class="advertisement">Buy this now.</div><p>Second one, which   goes on&nbsp;&amp; on for a while.</p>
<form action=/s><label>Your mail</label><button>Subscribe</button></form><p>The end.</p></article>
<section id="comments"><h2>2 comments</h2><article class="comment"><p>I liked this, it was a good read for me.</p></article></section></main>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href=/1>One</a></li><li><a href=/2>Two</a></li></ul></aside>
<footer>&copy; 2020 My Site. All rights reserved.</footer></body></html>"""


def test_a_page_of_another_make(model):
    assert H.main_texts([UNSEEN], model) == ["A fine title First paragraph of the story, with some words in it. Second one, which goes on & on for a while. The end."]


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article><p>Some text here.</p></article>", "Some text here."),
        ("<p>First of two paragraphs, with nothing around them.</p><p>And the second one, with a few words more.</p>", "First of two paragraphs, with nothing around them. And the second one, with a few words more."),
        ("<nav><a href=x>Menu</a></nav>", ""),
        ("<main>Text, and more of it.</main><footer>x</footer>", "Text, and more of it."),
        ("<footer>&copy; a b c.</footer>", ""),
    ],
)
def test_small_pages(model, page, want):
    assert H.main_texts([page], model) == [want]


def by_markup(page):
    """The article of the given table's pages, which all mark it."""
    found = re.search(r"<article>(.*?)</article>", page, re.S)
    text = re.sub(r"</?(?:p|h1)>|<br>", "\n", found.group(1))
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


def test_given_pages(spark):
    rows = H.op13_html_extract(spark, SF_MID).collect()
    pages = {(r["page_id"], r["url"]): r["html"] for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        assert r["text"] == by_markup(pages[r["page_id"], r["url"]])
        assert r["n_chars"] == len(r["text"])


def test_edge_rows(spark, scratch):
    long = "<article>" + "<p>word, word and so on it goes.</p>" * 60_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "x", UNSEEN), (3, "y", UNSEEN), (3, "y", UNSEEN), (4, "z", long), (5, "w", "<p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in ("text", "n_chars", "main_text", "place"):
        df = df.withColumn(name, F.lit(1))
    df.write.parquet(f"{scratch}/pages.parquet")
    got = {(r["page_id"], r["url"]): r for r in H.op13_html_extract(spark, scratch).collect()}
    assert got[1, "u"]["text"] == got[2, None]["text"] == got[5, "w"]["text"] == ""
    assert got[1, "u"]["n_chars"] == 0
    assert got[None, "x"]["text"].startswith("A fine title First") and got[3, "y"]["text"] == got[None, "x"]["text"]
    assert got[4, "z"]["n_chars"] == 60_000 * 30 - 1
    assert H.op13_html_extract(spark, scratch).count() == 7


def test_empty_table_and_other_columns(spark, model):
    df = spark.read.parquet(f"{SF_SMALL}/pages.parquet").limit(0)
    assert H.extract(df, model).count() == 0
    odd = spark.createDataFrame([(1, "<article><p>Some text here.</p></article>", [1, 2])], "`a.b` int, body string, arr array<int>")
    out = H.extract(odd, model, html="body")
    assert out.columns == ["a.b", "body", "arr", "main_text"]
    assert out.first()["main_text"] == "Some text here."
