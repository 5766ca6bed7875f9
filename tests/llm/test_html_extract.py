import html
import itertools
import random
import re

import pytest

from strata.llm import html_extract as h


def brute_cut(scores, edges):
    """Least cost over all labellings."""
    best = None
    for keep in itertools.product((False, True), repeat=len(scores)):
        cost = sum(s if not k else 0 for s, k in zip(scores, keep) if s > 0)
        cost += sum(-s if k else 0 for s, k in zip(scores, keep) if s < 0)
        cost += sum(w for a, b, w in edges if keep[a] != keep[b])
        best = cost if best is None else min(best, cost)
    return best


def test_min_cut_is_minimal():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randint(1, 9)
        scores = [rng.choice([-3, -1, -0.5, 0, 0.5, 1, 3]) * rng.random() for _ in range(n)]
        edges = [(a, b, rng.random()) for a in range(n) for b in range(a) if rng.random() < 0.4]
        keep = h.min_cut(scores, edges)
        cost = sum(s for s, k in zip(scores, keep) if s > 0 and not k) - sum(s for s, k in zip(scores, keep) if s < 0 and k)
        cost += sum(w for a, b, w in edges if keep[a] != keep[b])
        assert abs(cost - brute_cut(scores, edges)) < 1e-6


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
<header><a href=/>Site</a></header><div class="cookie-notice">We use cookies. Accept them all, please do.</div>
<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><script>var t="</p>";</script>
<div class='content-wrapper with-sidebar'><article><header><h1>Head&nbsp;line</h1></header>
<p><b>First &lt;b&gt; par<b>a</b>graph<br>here.<p>Short.<p>Second one, with a <a href=x>link</a> in it and more words.
<aside>Buy this now, it is a great offer for you.</aside><ul><li>item one<li>item two</ul>
<form><input name=q><label>Search the site for more of this</label><button>Go</button></form>
<div style="display: none">Hidden words that nobody sees here at all.</div><!-- a > comment <p>no</p> --></article>
<section class="comments"><article class="comment">I like this very much, thank you for the article.</article></section>
<div class="sidebar"><p>Other stories that you may like to read today.</p></div></div>
<footer>&copy; 2020 Site. All rights reserved.</footer></body></html>"""


def test_main_text():
    assert h.main_text(PAGE).split("\n\n") == [
        "Head line",
        "First <b> paragraph here.",
        "Short.",
        "Second one, with a link in it and more words.",
        "item one",
        "item two",
    ]


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<!-- never closed <p>x</p>", ""),
        ("<article>a < b and 3 <4 &amp;&copy; x</article>", "a < b and 3 <4 &© x"),
        ("</p></div><article><p>one<p>two</article></article>", "one\n\ntwo"),
        ("<article>one<div>two</div>three</article>", "one\n\ntwo\n\nthree"),
        ("<article><p>x<script>never closed", "x"),
        ("<article><p title='>'>q</p></article><p", "q"),
    ],
)
def test_odd_pages(page, text):
    assert h.main_text(page) == text


def test_without_article_element():
    words = "This is a long sentence of real text that goes on for quite a while, as text does."
    links = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(9))
    page = f"<body><ul>{links}</ul><div><h2>Title</h2><p>{words}</p><p>{words}</p></div><ul>{links}</ul>"
    assert h.main_text(page) == f"Title\n\n{words}\n\n{words}"


LONG = "This is a long sentence of real text that goes on for quite a while, as text does."
NAV = "<nav><a href=x>Home</a> <a href=y>News</a></nav>"


@pytest.mark.parametrize("n", [3, 8, 40])
@pytest.mark.parametrize(
    "run",
    ["<ul>{}</ul>", "<table><tr>{}</tr></table>", "<dl>{}</dl>", "{}"],
)
def test_short_runs_without_article_element(n, run):
    tag = {"<u": "li", "<t": "td", "<d": "dd", "{}": "p"}[run[:2]]
    items = [f"item {i}" for i in range(n)]
    inner = run.format("".join(f"<{tag}>{x}</{tag}>" for x in items))
    page = f"<body>{NAV}<div><p>{LONG}</p>{inner}<p>{LONG}</p></div><footer>© 2020 Site</footer>"
    assert h.main_text(page).split("\n\n") == [LONG, *items, LONG]
    if tag != "p":  # a list at the end
        page = f"<body>{NAV}<div><p>{LONG}</p>{inner}</div><p><a href=z>Next page</a></p><footer>© 2020 Site</footer>"
        assert h.main_text(page).split("\n\n") == [LONG, *items]


@pytest.mark.parametrize("cue", ["id='content'", "class=entry-content", ""])
def test_teaser_article_beside_the_text(cue):
    text = [LONG + str(i) for i in range(6)] + ["Short", "words", "here"]
    inner = "".join(f"<p>{x}</p>" for x in text) + f"<p>{LONG}</p>"
    teaser = "<article class=card><h3><a href=t>Another story</a></h3><p>Read it now.</p></article>"
    got = h.main_text(f"<body>{NAV}<div {cue}>{inner}</div>{teaser * 9}<footer>© 2020 Site</footer>")
    assert got.startswith("\n\n".join([*text, LONG])) and "2020" not in got and "Home" not in got


def test_content_class_keeps_short_blocks():
    page = f"<body>{NAV}<div class=entry-content><p>{LONG}</p><p>One</p><p>Two</p><p>Three</p></div>"
    assert h.main_text(page).split("\n\n") == [LONG, "One", "Two", "Three"]


def test_outside_of_the_leading_article_goes():
    page = f"<body><div><p>Some other words of the page.</p></div><article><p>{LONG}</p></article>"
    assert h.main_text(page) == LONG


def test_formulas_and_objects_stay():
    page = "<article><p>so <math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2 again</annotation></semantics></math> holds<p>see <object data=a.pdf>the table as text</object></article>"
    assert h.main_text(page) == "so x=2 holds\n\nsee the table as text"


OTHER = "Readers of this page said that they were quite happy with everything that they found there."


@pytest.mark.parametrize(
    "cue",
    ["id='post-comments'", "class='comment-body'", "class='user-comment comment-text'", "id='disqus_thread'",
     "id=postComments", "class='sidebar-content'", "class='ad'", "class='newsletter-cta'"],
)
@pytest.mark.parametrize("tag", ["article", "div class=entry-content", "div"])
def test_boilerplate_names_inside_the_text(tag, cue):
    page = f"<body>{NAV}<{tag}><p>{LONG}</p><p>{LONG}</p><div {cue}><p>{OTHER}</p></div></{tag.split()[0]}>"
    assert h.main_text(page) == f"{LONG}\n\n{LONG}"


@pytest.mark.parametrize("cue", ["sidebar-content", "footer-text", "widget post-list", "promotion"])
def test_boilerplate_names_beside_the_text(cue):
    page = f"<body>{NAV}<div><p>{LONG}</p><p>{LONG}</p></div><div class='{cue}'><p>{OTHER}</p></div>"
    assert h.main_text(page) == f"{LONG}\n\n{LONG}"


def test_a_menu_of_plain_items():
    menu = "<ul class='main-menu'><li>Home<li>About<li>News</ul>"
    assert h.main_text(f"<body>{menu}<div><p>{LONG}</p></div>") == LONG


@pytest.mark.parametrize("cue", ["share-price", "related-work", "informed-consent", "has-sidebar", "tag-social"])
@pytest.mark.parametrize("tag", ["article", "div class=entry-content", "div"])
def test_ambiguous_names_take_no_text(tag, cue):
    inner = f"<p>{LONG}</p><div class='{cue}'><p>{OTHER}</p><p>{LONG}</p></div><p>{LONG}</p>"
    page = f"<body>{NAV}<{tag}>{inner}</{tag.split()[0]}>"
    assert h.main_text(page).split("\n\n") == [LONG, OTHER, LONG, LONG]


def test_ambiguous_names_with_links_go():
    share = "<div class='share-story'><a href=f>Facebook</a> <a href=t>Twitter</a></div>"
    assert h.main_text(f"<article><p>{LONG}</p>{share}</article>") == LONG


def test_names_of_layout_around_the_text():
    page = f"<body>{NAV}<div class='content-sidebar-wrap with-sidebar'><div class=content><p>{LONG}</p></div><div class=sidebar><p>{OTHER}</p></div></div>"
    assert h.main_text(page) == LONG


def test_closing_run_of_short_paragraphs():
    page = f"<body>{NAV}<div><p>{LONG}</p><p>One</p><p>Two words</p><p>Three</p></div><footer>© 2020 Site</footer>"
    assert h.main_text(page).split("\n\n") == [LONG, "One", "Two words", "Three"]


def test_very_long_pages():
    page = "<article>" + "<p><b>some words <br>" * 20_000 + "</article>"
    assert h.main_text(page).count("\n\n") == 19_999
    assert len(h.main_text("<div>" * 20_000 + "x " * 500_000)) == 999_999


def test_query_on_whole_table(spark, tmp_path):
    path = "/root/testdata/sf0.001"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{path}/pages.parquet").collect()}
    rows = h.op6(spark, path).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", inner)
        want = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in parts]
        assert r.text == "\n\n".join(filter(None, want)) and r.n_chars == len(r.text)
    odd = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", "<article>x")], "page_id long, url string, html string")
    assert sorted(r.text for r in h.extract(odd.selectExpr("*", "1 as text")).collect()) == ["", "", "x"]
    assert h.extract(odd.limit(0)).count() == 0
