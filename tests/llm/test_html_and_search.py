"""Extraction against a plain reading of the given pages, expressions, and search against brute force."""

import html as entities
import re

import numpy as np
import pytest
from llm_fixtures import rows
from pyspark.sql import functions as F

from tickerloom.llm import ann, html


# ---- html --------------------------------------------------------------
def plain(page):
    """The given pages have one article of headings and paragraphs and nothing else in it."""
    body = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", body)
    texts = [" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", x))).split()) for x in parts]
    return "\n".join(t for t in texts if t)


def test_given_pages_match_a_plain_reading(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r for r in html.extract(pages).collect()}
    source = pages.collect()
    assert len(got) == len(source)
    for r in source:
        assert got[r["page_id"]]["text"] == plain(r["html"]) and got[r["page_id"]]["n_chars"] == len(plain(r["html"]))


PAGE = """<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t="</p><p>no</p>";</script></head>
<body class="has-sidebar"><header class="site-header"><p>Site {i}</p></header><nav><ul><li><a href="/x">menu {i}</a></ul></nav><!-- c -->
<div class="cookie-notice">We use <b>cookies</b> {i}</div><div class="ad-slot">buy {i}</div><main><article><header><h1>Title &amp; more {i}</h1></header>
<p>One <b>two</b>{i}
 three<br>four<p>Five{i} &#233;&nbsp;&nbsp;six &lt;b&gt;<ul><li>i1 {i}<li>i2</ul>{extra}<aside>related</aside><form>f<input></form><p>if a < b then {i}</p>
<p>Read our terms.</p></article></main><section id="comments"><p>reader {i}</p></section><aside class="sidebar">s {i}</aside>
<div style="display: none">hidden {i}</div><footer>&copy; f</footer></body></html>"""


def test_boilerplate_goes_and_article_stays(spark):
    data = [(i, f"https://Host.example.org:80/a/{i}", PAGE.format(i=i, extra="<blockquote><p>q</p></blockquote>" if i % 2 else "")) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    for i in range(12):
        quote = ["q"] if i % 2 else []
        expected = [f"Title & more {i}", f"One two{i} three four", f"Five{i} é six <b>", f"i1 {i}", "i2", *quote, f"if a < b then {i}", "Read our terms."]
        assert got[i].split("\n") == expected


@pytest.mark.parametrize("pages", [9, 10, 12])
def test_repeated_article_blocks_stay(spark, pages):
    data = [(i, f"https://host.example.org/a/{i}", PAGE.format(i=i, extra="")) for i in range(pages)]
    data += [(100 + i, f"https://copies.example.org/{i}", f"<main><h1>One</h1><p>The same.</p><p>Again.</p></main><footer>{i}</footer>") for i in range(pages)]
    data += [(200 + i, f"https://plain.example.org/{i}", f"<div><p>The same.</p><p>{i}</p></div>") for i in range(pages)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    for i in range(pages):
        assert got[i].split("\n") == [f"Title & more {i}", f"One two{i} three four", f"Five{i} é six <b>", f"i1 {i}", "i2", f"if a < b then {i}", "Read our terms."]
        assert got[100 + i] == "One\nThe same.\nAgain." and got[200 + i] == f"The same.\n{i}"


NAMED = [
    ('<div class="content-with-sidebar"><p>a</p></div><p>b</p>', "a b"),
    ('<div id="main" class="layout-sidebar-right sidebar"><p>a</p></div><div class="sidebar">no</div>', "a"),
    ('<article><section class="discussion"><p>a</p></section><h2 class="section-header">b</h2><p>c</p><div class="share-buttons">no</div></article>', "a b c"),
    ('<form action="/"><div><p>a long body of a page within a form</p></div><div class="footer">no</div></form><p>b</p>', "a long body of a page within a form b"),
    ('<form><nav>no no no no no no no no</nav><article><p>a</p></article></form>', "a"),
    ('<div class="page-banner"><article><p>a</p></article></div><nav>no no no no</nav>', "a"),
    ('<article><h1>a</h1><form><p>no: a form is left out however much it holds</p></form></article>', "a"),
    ('<p>a</p><div class="cookie-banner">no no no no no no no no</div>', "a"),
    ('<p>a</p><div class="sidebar"><p>no no no no no no no no</p></div>', "a"),
    ('<h1>a</h1><p>b</p><div class="ad">no no no no no no no</div><div class="footer">no no no no no no</div>', "a b"),
    ('<article><h1>a</h1><div class="notice">no</div><div class="alert">no</div><p>b</p><div class="feedback">no</div><div class="search-form">no</div></article>', "a b"),
    ('<div class="post"><h1>a</h1><p>a long body</p></div><article class="teaser"><p>no</p></article>', "a a long body"),
    ('<div class="post"><h1>a</h1><p>a long body</p></div><article><p>b</p></article>', "a a long body b"),
    ('<p>no</p><div><h1>a</h1><article><p>b</p></article></div><p>no</p>', "a b"),
    ('<h1>a</h1><article><p>b</p></article><div><p>no</p></div>', "a b"),
    ('<article><p>a</p><article class="comment"><p>no</p></article></article>', "a"),
    ('<form class="search"><p>no</p><button>no</button></form><p>a</p>', "a"),
    *[
        (f'<article><h1>a</h1><p>b</p><div class="{name}"><p>no</p></div></article>', "a b")
        for name in (
            "related-articles", "read-more", "author-bio", "adsbygoogle", "ads-top", "ad-banner-top", "disqus_thread", "comment-body", "sidebar-right",
            "nav-bar-top", "cookie-consent-text", "related_articles right",
        )
    ],
    ('<div class="header-top">no</div><div class="site-header-top">no</div><p>a</p>', "a"),
    ('<div><p>a</p></div><section id="comments"><article><p>no, a long comment of a reader</p></article></section>', "a"),
    ('<p>some text of the page</p><form>no</form><div class="site-footer">no</div><div class="ad-slot">no</div>', "some text of the page"),
    ('<article><p>a</p></article><nav class="main">no no no no no</nav><div style="display:none">no no no no no</div>', "a"),
]


@pytest.mark.parametrize("page,text", NAMED)
def test_names_cut_no_article(page, text):
    stream, texts = html.blocks(page)
    paths = frozenset(html.content_paths(html.show(html.nested(html.safe(stream)))))
    assert " ".join(html.article([("/".join(html.safe(p.split("/"))), t) for p, t in texts], paths)) == text


def test_region_is_chosen_per_page(spark):
    data = [
        (1, "<article><h1>A</h1><p>one</p></article>"), (2, '<div class=post><h1>T</h1><p>long body</p></div><article class=teaser><p>x</p></article>'),
        (3, "<h1>H</h1><article><p>three</p></article><div><p>aside</p></div>"), (4, "<div><p>no region</p></div>"),
    ]
    pages = spark.createDataFrame([(i, "https://h.org/" + str(i), h) for i, h in data], "page_id long, url string, html string")
    assert rows(html.extract(pages), "page_id", "text") == [(1, "A\none"), (2, "T\nlong body"), (3, "H\nthree"), (4, "no region")]


def test_pages_odd_rows(spark):
    data = [
        (1, None, None), (2, "https://a.org/1", ""), (3, "no url", "just text"), (None, "https://a.org/2", "<p>x &amp; y"), (4, None, "<div a='b\" c=d"),
        (5, "https://a.org/3", "<article>" + "<p>z é</p>" * 30_000 + "</article>"), (5, "https://a.org/3", "<p>again</p>"), (6, "https://a.org/4", "<script>never closed"),
    ]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({"text": F.lit("x"), "host": F.lit(1), "blocks": F.lit(2)})
    got = html.extract(pages)
    assert got.count() == len(data) and got.where("text is null or n_chars <> length(text)").count() == 0
    found = {(r["page_id"], r["text"][:9], r["n_chars"]) for r in got.collect()}
    assert found == {
        (1, "", 0), (2, "", 0), (3, "just text", 9), (None, "x & y", 5), (4, "", 0), (5, "z é\nz é\nz", 119_999), (5, "again", 5), (6, "", 0),
    }
    assert html.extract(pages.limit(0)).count() == 0


def test_expressions_are_union_free():
    stream = lambda page: html.nested(html.safe(html.blocks(page)[0]))
    one = stream("<article><h1>a</h1><p>b</p><p>c</p><div class=x>k</div></article>")
    two = stream("<article><h1>a</h1><p>b</p></article><footer>d</footer>")
    merged = html.align(one, two)
    assert html.show(merged) == "(<marticle (<.h1 #) (<.p #)+ (<.div.x #)?) (<bfooter #)?"
    assert html.parse(html.show(merged)) == merged and "|" not in html.show(merged)
    pairs = stream("<ul><li>a</li></ul><p>b</p><ul><li>a</li><li>c</li></ul><p>b</p>")
    assert html.show(pairs) == "((<.ul (<.li #)+) (<.p #))+"
    assert html.content_paths(html.show(merged)) == ["marticle/.h1", "marticle/.p", "marticle/.div.x"]


MIXED = ["h1 p", "h1 p h2 p h2 p", "p ul p ul p", "p", "p h2 p h2 ul p h2 p h2 ul", "h2 p h2 p", "p ul", "h1 p ul h2 p ul h2", "p h2 h2 p h2 h2"]


def test_groups_and_elements_keep_their_levels():
    page = lambda tags: "<article>" + "".join(f"<{t}><li>x</li></{t}>" if t == "ul" else f"<{t}>x</{t}>" for t in tags.split()) + "</article>"
    parsed = [html.blocks(page(tags)) for tags in MIXED]
    terms = [html.nested(html.safe(stream)) for stream, _ in parsed]
    merged = html.align(terms[1], terms[0])
    assert set(html.slots(merged)) == {"marticle/.h1", "marticle/.p", "marticle/.h2"}
    for i, a in enumerate(terms):
        for j, b in enumerate(terms):
            for k, c in enumerate(terms):
                found = set(html.slots(html.parse(html.show(html.align(html.align(a, b), c)))))
                assert found == {path for x in (i, j, k) for path, _ in parsed[x][1]}, (MIXED[i], MIXED[j], MIXED[k])


def test_hosts_of_mixed_articles_lose_no_block(spark):
    page = lambda i, tags: f"<article>{''.join(f'<{t}>{t} {n} of {i}</{t}>' for n, t in enumerate(tags.split()))}</article>"
    data = [(i, f"https://h{host}.org/{i}", page(i, tags)) for host, shapes in enumerate((MIXED[:2], MIXED[:3], MIXED)) for i, tags in enumerate(shapes, 100 * host)]
    got = {r["page_id"]: r["text"] for r in html.extract(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    for i, _, source in data:
        assert got[i].split("\n") == re.findall(r">([^<>]+)<", source)


def test_wrappers_of_many_streams_meet_in_rounds(spark):
    data = [("h", html.show(html.nested(html.safe(html.blocks(f"<article><p>a</p>{'<div class=c' + str(i) + 'x><p>b</p></div>'}</article>")[0]))), 1) for i in range(9)]
    data += [("g", "(<.p #)", 5)]
    found = dict(rows(html.wrappers(spark.createDataFrame(data, "host string, expression string, n long"), chunk=3), "host", "expression"))
    assert set(found) == {"h", "g"} and found["g"] == "(<.p #)" and "(<.p #)" in found["h"]


# ---- search ------------------------------------------------------------
def by_force(ids, x, k):
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = n @ n[i]
        s[ids == ids[i]] = -np.inf
        order = np.lexsort((ids, -np.round(s, 12)))[: min(k, int(np.isfinite(s).sum()))]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


@pytest.mark.parametrize("spread", [0.3, 1.0])
def test_recall_against_brute_force(spark, spread):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 24))[rng.integers(0, 20, 6000)] + spread * rng.normal(size=(6000, 24))
    x[100:400] = x[100]  # one vector many times: ties go to the smaller id
    ids = rng.permutation(6000)
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<double>")
    found = {}
    for r in ann.search(table, F.col("vec_id") % 50 == 0, rows_per_part=500).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    wanted, hits = by_force(ids, x, 5), 0
    assert set(found) == set(wanted)
    for q, best in wanted.items():
        got = sorted(found[q])
        assert [r for r, _, _ in got] == [1, 2, 3, 4, 5]
        assert [(s, -i) for _, i, s in got] == sorted([(s, -i) for _, i, s in got], reverse=True)
        hits += len({i for _, i, _ in got} & {i for i, _ in best})
    assert hits >= 0.9 * 5 * len(wanted)
    copies = sorted(int(i) for i in ids[100:400])
    for q in (q for q in wanted if q in copies):
        assert [i for _, i, _ in sorted(found[q])] == [i for i in copies if i != q][:5]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 2.0]), (1, [1.0, 1.0])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumns({"v": F.lit(1), "score": F.lit(2), "part": F.lit(3)})
    got = rows(ann.search(table, F.col("vec_id") % 50 == 0), "query_id", "rank", "vec_id")
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 1), (50, 2, 2), (50, 3, 0)]
    assert ann.search(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0
