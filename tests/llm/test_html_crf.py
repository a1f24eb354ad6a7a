import itertools
import random
from math import exp, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import html_crf as H

PROSE = ["Rain fell on the harbour all night, and the boats were full of it by morning.", "Nobody had expected the old bridge to hold, but it did.",
         "The council agreed to wait until spring.", "A long walk, then supper.", "Prices rose again in the autumn, as they had the year before."]
PAGE = ("<!DOCTYPE html><html lang=en><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></li>"
        "<li><a href=/b>News</a></li></ul></nav><!-- x --><div class=\"ad\">Buy things now.</div><article><h1>Title &amp; more</h1>{body}</article>"
        "<footer>&copy; site</footer></body></html>")


@pytest.fixture(scope="module")
def model():
    pages = [PAGE.format(body="".join(f"<p>{PROSE[(i + j) % 5]}</p>" for j in range(1 + i % 5))) for i in range(40)]
    return H.train(H.training_set(pages))


def text_of(html):
    return [t for t, _ in H.blocks(html)]


@pytest.mark.parametrize("html, want", [
    (None, []), ("", []), ("plain", ["plain"]), ("<p>a<p>b", ["a", "b"]), ("<p><b>x<br><p>y</p>", ["x", "y"]), ("a<br>b  c\n\td", ["a b c d"]),
    ("<p>f<i>oo</i> b</p>", ["foo b"]), ("<script>if (a<b) '</p>'</script>x", ["x"]), ("<script>open", []), ("<!-- a --><!-- b", []),
    ("<p>1 &lt; 2 &amp;amp; &eacute;&#233;&#x41; &am", ["1 < 2 &amp; ééA &am"]), ("<p>a<", ["a<"]), ("<p>a<b class='x", ["a"]), ("<p title='a>b'>c</p>", ["c"]),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]), ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("</p></div>x</p>", ["x"]),
    ("<P CLASS=A>x</P>", ["x"]), ("a &nbsp; b", ["a b"]), ("<style>x", []), ("<textarea>t</textarea>z", ["z"]), ("<p>😀 é</p>", ["😀 é"])])
def test_blocks(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize("html, want", [
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>", ["so x=2 holds"]), ("<p>a<svg><text>b</text><path/></svg> c</p><p>d", ["ab c", "d"]),
    ("<video src=v><p>a</p><p>b</p>", ["a", "b"]), ("<div><object data=o><p>a</div><p>b", ["a", "b"]), ("<p>a <audio>b</audio><p>c", ["a b", "c"]),
    ("<p>a<svg class=icon><path d=m><p>b</p>", ["a", "b"]), ("<canvas>a</canvas>b<svg/>c<p>d", ["abc", "d"]), ("<svg><style>p{}</style><title>t</title></svg>x", ["x"])])
def test_text_of_embedded_elements_is_kept(html, want):
    assert text_of(html) == want


@pytest.mark.parametrize("inside", ["<math><msup><mi>x</mi><mn>2</mn></msup></math>", "<svg class=ad><path d='m'/><g><text>x2</text></g></svg>", "<svg class=ad />x2",
                                    "<math class=ad><mspace/><mi>x2</mi></math>", "<video class=ad><source src=v>x2</video>"])
def test_embedded_elements_leave_the_features_of_their_block(inside):
    assert H.blocks(f"<article><p>See {inside} here.</p><p>Next.</p></article>") == H.blocks("<article><p>See x2 here.</p><p>Next.</p></article>")


def test_article_text_beside_embedded_elements(model):
    body = f"<p>{PROSE[0]}</p><video src=v><p>{PROSE[1]} <math><mi>y</mi></math></p><p>{PROSE[4]}</p>"
    assert H.main_text(PAGE.format(body=body), model) == "\n".join(["Title & more", PROSE[0], f"{PROSE[1]} y", PROSE[4]])


def test_deep_and_long_pages_take_linear_time():
    assert text_of("<div>" * 30000 + "x") == ["x"]
    assert len(text_of("<p>word " * 30000)) == 30000
    assert text_of('<a "' * 3000) == []


def test_viterbi_finds_the_best_labels():
    r = random.Random(1)
    for _ in range(40):
        m = H.Model({f"f{i}": r.uniform(-2, 2) for i in range(5)}, [[r.uniform(-1, 1) for _ in range(2)] for _ in range(2)])
        x = [tuple(r.choices([f"f{i}" for i in range(6)], k=2)) for _ in range(r.randint(1, 8))]

        def value(y):
            return sum(sum(m.weights.get(f, 0) for f in fs) for fs, l in zip(x, y) if l) + sum(m.transitions[a][b] for a, b in zip(y, y[1:]))

        assert abs(value(m.labels(x)) - max(map(value, itertools.product((0, 1), repeat=len(x))))) < 1e-9
        z = log(sum(exp(value(y)) for y in itertools.product((0, 1), repeat=len(x))))
        y = tuple(r.choices((0, 1), k=len(x)))
        assert abs(H.log_likelihood(m, list(zip(x, y))) - (value(y) - z)) < 1e-9


def test_forward_backward_matches_enumeration():
    r = random.Random(2)
    s, t = [r.uniform(-2, 2) for _ in range(7)], [r.uniform(-1, 1) for _ in range(4)]
    p, e = H._forward_backward(s, t, [0, 3, 7])
    want_p, want_e = [], np.zeros(4)
    for a, b in ((0, 3), (3, 7)):
        ys = list(itertools.product((0, 1), repeat=b - a))
        w = np.array([exp(sum(x for x, l in zip(s[a:b], y) if l) + sum(t[2 * i + j] for i, j in zip(y, y[1:]))) for y in ys])
        w /= w.sum()
        want_p += [sum(q for q, y in zip(w, ys) if y[k]) for k in range(b - a)]
        for q, y in zip(w, ys):
            for i, j in zip(y, y[1:]):
                want_e[2 * i + j] += q
    assert np.allclose(p, want_p) and np.allclose(e, want_e)


def test_training_raises_the_likelihood():
    chains = H.training_set([PAGE.format(body="<p>" + "</p><p>".join(PROSE) + "</p>")])
    start, end = H.Model({}, [[0, 0], [0, 0]]), H.train(chains)
    assert sum(H.log_likelihood(end, c) for c in chains) > 0.1 * sum(H.log_likelihood(start, c) for c in chains)


def test_semantic_page(model):
    got = H.main_text(PAGE.format(body="".join(f"<p>{x}</p>" for x in PROSE)), model)
    assert got == "\n".join(["Title & more", *PROSE])


BODY = "".join(f"<p>{x}</p>" for x in PROSE)
OTHER = [
    f"<body><div class='top-menu'><a href=#>Home</a> <a href=#>News</a></div><div class='post-content'><h1>Head</h1>{BODY}</div><div class='sidebar'><h3>Links</h3><ul><li><a href=#>One</a></li></ul></div><div id='footer'>&copy; all rights</div>",
    f"<body><header><h1>Site</h1></header><main><h1>Head</h1>{BODY}</main><section class='comments'><h3>Comments</h3><div class='comment'><p>I like this a lot, thanks.</p></div></section><form><label>Name</label><button>Send</button></form><footer>Imprint</footer>",
    f"<body><div class='cookie-banner'>We use cookies.<button>OK</button></div><article><h1>Head</h1>{BODY}</article><aside><p>Also read this other story, it is good.</p></aside>",
]


@pytest.mark.parametrize("page", OTHER)
def test_other_layouts(model, page):
    assert H.main_text(page, model) == "\n".join(["Head", *PROSE])


def test_operator(spark):
    rows = [(i, f"u{i}", PAGE.format(body=f"<p>{PROSE[i % 5]}</p>"), "t", 1) for i in range(30)] + [(30, "u", None, "t", 1), (31, None, "", "t", 1), (None, "u", PAGE.format(body=""), "t", 1)]
    rows += [rows[0]] * 2 + [(40, "u", PAGE.format(body="<p>" + "long text. " * 20000 + "</p>"), "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text string, other int").repartition(3)
    got = H.extract(pages)
    assert got.columns == ["page_id", "url", "html", "other", "text", "n_chars"]
    out = {r.page_id: r for r in got.collect()}
    assert got.count() == len(rows) and out[30].text == "" and out[31].n_chars == 0 and out[3].text == f"Title & more\n{PROSE[3]}"
    assert out[40].n_chars == len(out[40].text) > 200000
    assert H.extract(pages.where(F.lit(False))).count() == 0


def test_no_page_to_learn_from(spark):
    got = H.extract(spark.createDataFrame([(1, f"<body><div class=menu>Home</div><div class='article-body'>{BODY}</div>")], "page_id long, html string")).first()
    assert got.text == "\n".join(PROSE)


def test_all_class_words_count():
    words = " ".join(f"w{chr(97 + i)}x" for i in range(20))
    (_, features), = H.blocks(f'<div class="{words} sidebar"><p>text</p></div>')
    assert "c=sidebar" in features and sum(f.startswith("c=") for f in features) == 21


@pytest.mark.parametrize("inside", ["", "<b>", "<b><i>", "<a><b><i><u><em><span><small>"])
def test_an_end_tag_reaches_its_paragraph(inside):
    (_, one), (_, tail) = H.blocks(f"<div><p>{inside}x</p>tail</div>")
    assert "p" in one and "p" not in tail and "div" in tail


def test_scores_by_ancestor_sums_are_those_of_all_features(spark, model):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()]
    for page in [*pages, "<div class='a b'><p class='a'>x</p><nav>y</nav></div>z", None, ""]:
        plain = H.blocks(page)
        assert H.main_text(page, model) == "\n".join(t for (t, _), y in zip(plain, model.labels(H.sequence(plain))) if y)


def test_hostile_pages_take_linear_time(model):
    import time

    def seconds(page):
        t = time.time()
        H.main_text(page, model)
        return time.time() - t

    for make in (lambda n: "<span>" * n + "x" + "</b>" * n + "</i></p>" * n, lambda n: "".join(f"<div class=k{i}a>t" for i in range(n)),
                 lambda n: "<ul>" * n + "<li>x" * n, lambda n: "<p><b>x" * n, lambda n: "<td>" * n + "</table>" * n):
        seconds(make(2000))
        assert seconds(make(32000)) < 12 * max(seconds(make(8000)), 0.05)


def test_copies_do_not_crowd_out_the_sample(spark):
    page = "<article><h1>T</h1><p>One, two, three.</p></article><footer>end</footer>"
    other = "<body><nav>a</nav><main><p>Four, five.</p></main></body>"
    df = spark.createDataFrame([(i, page) for i in range(500)] + [(501, other), (502, None)], "page_id long, html string")
    assert "main" in H.fit(df, fit_pages=2).weights
