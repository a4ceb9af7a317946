from __future__ import annotations

import itertools
import math
import time
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import html_text as H

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
    "<nav><ul><li><a href=/x>Home</a></li></ul></nav><div class='ad'>Buy this now.</div><!-- <p>no</p> -->"
    "<article><h1>A &amp; B</h1><p><b>First   text&nbsp;here.<br>More<p>Second, with <a href=y>a link</a> in it.</p></article>"
    "<footer>&copy; site</footer></body></html>"
)


@pytest.fixture(scope="module")
def model():
    total = Counter({k: 20 * n for k, n in H.counts(H.EXAMPLES).items()})
    for _ in range(100):
        total.update(H.counts([PAGE]))
    return H.model(total)


def test_article_is_extracted(model):
    assert H.extract([PAGE, "", PAGE], model) == ["A & B\n\nFirst text here. More\n\nSecond, with a link in it.", "", "A & B\n\nFirst text here. More\n\nSecond, with a link in it."]


def test_examples_are_extracted_without_their_marks(model):
    for example in H.EXAMPLES:
        tree = H.parse(example)
        wanted = "\n\n".join(t for t, yes in zip(tree.text, H.labels(tree), strict=True) if t and yes)
        assert H.extract([example.replace(' data-content="1"', "")], model) == [wanted]


def test_marginals_equal_enumeration(model):
    tree = H.parse("<div class=ad><p>Some text</p>tail</div><article><p>Words</p></article>")
    n = len(tree.parent)
    weights = {}
    for labels in itertools.product((0, 1), repeat=n):
        total = 0.0
        for node, label in enumerate(labels):
            total += sum(model.own.get(f, (0.0, 0.0))[label] for f in H.features(tree, node))
            parent = tree.parent[node]
            names = [n for n in H.relation(tree, node) if n in model.pair] + [None]
            total += model.prior[label] if parent < 0 else model.pair[names[0]][labels[parent]][label]
        weights[labels] = math.exp(total)
    z = sum(weights.values())
    exact = [sum(w for labels, w in weights.items() if labels[node]) / z for node in range(n)]
    assert np.allclose(H.marginals([tree], model), exact)
    # Several trees at once are independent of each other.
    assert np.allclose(H.marginals([H.parse(PAGE), tree], model)[-n:], exact)


@pytest.mark.parametrize("page", ["<", "<p", "</p></div>", "<script>", "<!--", "a < b > c", "<p>" * 3000, "&#xD800;&bogus;", "<a><p></a>x", "<![CDATA["])
def test_broken_pages_are_borne(model, page):
    assert isinstance(H.extract([page], model)[0], str)


def test_tables(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", "y"), (3, "w", "<p>" + "long text " * 50_000, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    model = H.fit(pages)
    got = H.texts(pages, model)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {r.page_id: (r.text, r.n_chars) for r in got.collect()}
    assert got.count() == 5 and found[2] == ("", 0) and found[None] == ("", 0)
    assert found[1][0].startswith("A & B\n\nFirst") and found[1][1] == len(found[1][0])
    assert H.texts(pages.where("false"), H.fit(pages.where("false"))).count() == 0


def test_formulas_and_fallback_texts_are_read():
    page = (
        "<body><article><p>The sum <math><mi>a</mi><mo>+</mo><mi>b</mi></math> is known to all of the readers here.</p>"
        "<object data=x><p>A text in place of the object, long enough to be read.</p></object>"
        "<noscript><p>A text for readers without scripts, long enough to be read.</p></noscript>"
        "<script>no text</script><button>Send</button></article></body>"
    )
    found = H.extract([page], H.model(H.counts(H.EXAMPLES)))[0]
    for part in ("The sum a+b is known", "A text in place of the object", "A text for readers without scripts"):
        assert part in found
    assert "no text" not in found and "Send" not in found


WORDS = "Words of the article that are long enough to be read by anyone who likes to read them."


@pytest.mark.parametrize(
    "before",
    [
        "<button>Menu", "<form><button>Menu</form>", "<datalist><option>a<option>b</datalist>", "<select><option>a<option>b</select>",
        "<svg><title>Icon</title><style/></svg>", "<select><option>a", "<svg><title>Icon</svg>", "<template><p>later</p></template>",
    ],
)
def test_articles_behind_unclosed_elements_are_found(model, before):
    page = f"<html><head><title>T</title><body>{before}<article><h1>Title</h1><p>{WORDS}</p></article><p><button>x</button><option>y</option></body>"
    assert H.extract([page], model) == [f"Title\n\n{WORDS}"]


def test_head_without_an_end_and_its_end_in_a_text(model):
    page = f"<html><head><title>T</title><meta charset=x><article><h1>Title</h1><p>{WORDS}</p><pre>&lt;head> </head></pre></article>"
    assert H.extract([page], model)[0].startswith(f"Title\n\n{WORDS}")
    assert H.extract([f"<head><title>T</head><article><h1>Title</h1><p>{WORDS}</p></article>"], model)[0].endswith(WORDS)


def test_comments_that_are_articles_and_forms_are_left_out(model):
    page = (
        f"<body><article><h1>Title</h1><p>{WORDS}</p><form><p>Write to us, we would like to hear from all of you.</p>"
        f"<input name=x></form><p>{WORDS}</p></article><div class='comment-list'><ol><li><article><p>{WORDS} I agree.</p></article></li>"
        f"<li><article><h4>Anna</h4><p>{WORDS} So do I.</p></article></li></ol></div></body>"
    )
    assert H.extract([page], model) == [f"Title\n\n{WORDS}\n\n{WORDS}"]
    assert H.extract([f"<body><form><article><h1>Title</h1><p>{WORDS}</p></article></form></body>"], model) == [f"Title\n\n{WORDS}"]


@pytest.mark.parametrize(
    "page", ["<div>" * 200_000, "<div>" * 100_000 + "</p>" * 100_000, "<option>" * 120_000, "<title>" * 150_000, "<p><div><b-c>" * 80_000, "<li>" * 250_000]
)
def test_a_megabyte_of_tags_takes_seconds(model, page):
    start = time.perf_counter()
    H.extract([page + f"<article><p>{WORDS}</p></article>"], model)
    assert time.perf_counter() - start < 12


def test_deep_texts_are_read(model):
    page = "<article>" + "<div>" * 1000 + f"<p>{WORDS}</p>" + "</div>" * 1000 + f"<p>{WORDS}</p></article>"
    tree = H.parse(page)
    assert [t for t in tree.text if t] == [WORDS, WORDS] and len(tree.parent) == 1006


def test_one_id_on_many_rows_is_one_sample(spark):
    pages = spark.range(3000).selectExpr("1L AS page_id", f"concat('<article><p>', id, ' {WORDS}</p></article>') AS html")
    learned = Counter()
    real = H.model
    try:
        H.model = lambda total: learned.update(total) or real(total)
        H.fit(pages.union(pages), limit=10)
    finally:
        H.model = real
    assert 10 <= learned["label", True] <= 10 * 5 + 200
