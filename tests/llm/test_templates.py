from __future__ import annotations

import html
import re

import pytest

from comptoir.llm import queries
from comptoir.llm import templates as tp
from tests.conftest import SF


def brute(page):
    """The synthetic pages have one article each; this reads it with patterns alone."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.DOTALL)
    if not body:
        return ""
    text = re.sub(r"</?(?:p|h1|br|li|div)[^>]*>", " ", body[1])
    return " ".join(html.unescape(re.sub(r"<[^>]*>", "", text)).split())


def test_synthetic_pages(spark):
    pages = {r.page_id: r.html for r in queries.table(spark, SF, "pages").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in queries.op2_template_extraction(spark, SF).collect()}
    assert got == {i: (brute(h), len(brute(h))) for i, h in pages.items()}


PAGES = {
    "<p>a &amp; b&nbsp;c&#233;&#x1F642;</p><p>  d\n\t e<b>f</b>g <br>h</p>": "a & b cé🙂 d efg h",
    "<nav>x</nav><header>h</header><main><h1>T</h1><p>one<p>two<div class='comments'><p>no</p></div></main><footer>f</footer>": "T one two",
    "<body><div id=sidebar>x</div><article><header><h1>T</h1></header>b<aside>c</aside><form>d<button>e</button></form></article>t": "T b",
    "<script>var t='</p>';<p>no</script><style>p{}</style><p>yes": "yes",
    "<p>1 < 2 and 3 > 2</p><!-- <p>no</p> --><p title='a>b'>ok</p>": "1 < 2 and 3 > 2 ok",
    "<div class='cookie-notice'>no</div><div class='ad'>no</div><div class='address'>yes</div>": "yes",
    "": "", "plain text": "plain text", "<": "<", "<p": "<p", "<article></article><p>rest</p>": "rest",
    "<ul class=menu><li>x</ul><ul><li>a<li>b</ul>": "a b", "<table><tr><td>a<td>b<tr><td>c</table>": "a b c",
    "<article class='comment'><p>no</p></article><p>yes</p>": "yes", "<script>never closed <p>no": "", "<!-- open <p>no": "",
    "<body class='has-sidebar menu-open'><main class='with-ads'><div class='no-sidebar'>a<div class='right-sidebar'>b</div></div></main>": "a",
    "<article class='post nav-item' id='main'><p>a</p><section id='comments'><p>b</p></section></article>": "a",
    "<article>" + "<div>" * 3000 + "deep": "deep",
}


@pytest.mark.parametrize("page", PAGES)
def test_single_pages(page):
    assert tp.main_text(page, None) == PAGES[page]


def test_template_of_a_host(spark):
    """Fixed texts of a host without article elements go, texts that differ stay."""
    page = "<html><body><div><p>Welcome to the site</p></div><div><p>story {0} of many</p><p>more {0}</p></div><div>all rights reserved</div></body></html>"
    rows = [(i, f"http://h.example/{i}", page.format(i)) for i in range(6)] + [(9, "http://other.example/", page.format(9)), (10, None, page.format(10))]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in tp.extract(df).collect()}
    assert got[3] == "story 3 of many more 3"
    for alone in (9, 10):
        assert got[alone] == f"Welcome to the site story {alone} of many more {alone} all rights reserved"


def test_classes_share_occurrence_vectors(spark):
    rows = [(1, "h", "<p>a</p><p>b</p><div>z</div>"), (2, "h", "<p>c</p><div>z</div>"), (3, "h", "<p>c</p><p>d</p><div>z</div>")]
    vectors = tp.occurrence_vectors(spark.createDataFrame([(h, i, p) for i, h, p in rows], "host string, page long, html string"))
    found = {(r.path, bool(r.text)): (r.pages, r.times, tuple(r.vector)) for r in vectors.collect() if r.path in ("", "div", "p") and (r.path != "p" or not r.text)}
    assert found["", False] == found["div", False] == found["div", True]
    assert found["p", False][:2] == (3, 5) and found["p", False][2] != found["div", False][2]


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, None, None), (1, "http://a/", None), (1, "http://a/", "<p>x"), (1, "http://a/", "<p>x")], "page_id long, url string, html string")
    got = sorted(((r.page_id, r.text) for r in tp.extract(df).collect()), key=str)
    assert got == [(1, ""), (1, "x"), (1, "x"), (None, "")]
    assert tp.extract(df.limit(0)).count() == 0


def texts(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    return [r.text for r in tp.extract(df).orderBy("page_id").collect()]


def test_copies_are_no_template(spark):
    """Copies of a text on hosts of two and three pages without article elements keep it."""
    a, b = ("<body><div><p>Welcome</p></div>" + "".join(f"<p>{t}{i}</p>" for i in range(9)) + "</body>" for t in "ab")
    whole = ["Welcome " + " ".join(f"{t}{i}" for i in range(9)) for t in "ab"]
    assert texts(spark, [("http://h/1?a", a), ("http://h/1?b", a)]) == [whole[0]] * 2
    assert texts(spark, [("http://h/1?a", a), ("http://h/1?b", a), ("http://h/2", b)]) == [whole[0], whole[0], whole[1]]
    # copies count once, so what most of the differing pages share is still found
    rest = [a.replace("a", f"c{i}x") for i in range(3)]
    got = texts(spark, [(f"http://h/{i}", p.replace("Welcome", "Hello")) for i, p in enumerate([a] * 8 + rest)])
    assert got[0] == whole[0].removeprefix("Welcome ") and not any("Hello" in t for t in got)


def test_large_templates_are_sent_whole(spark):
    """5000 fixed texts in plain elements go like five do."""
    menu = "<div>" + "".join(f"<div>go to {i}</div>" for i in range(5000)) + "</div>"
    assert texts(spark, [(f"http://h/{i}", f"<body>{menu}<p>story {i}</p></body>") for i in range(4)]) == [f"story {i}" for i in range(4)]


def test_fixed_texts_inside_the_article(spark):
    """Boilerplate without a telling name goes from the article by its class; titles and paragraphs stay, whoever shares them."""
    page = "<article><h1>{t}</h1><p>story {i} has words of its own {i}</p><p>{s}</p><div class=x1>Tell your friends</div><section>{i} by hand</section></article>"
    pages = [page.format(i=i, t="News" if i < 4 else f"Title {i}", s="shared by some" if i % 2 else f"own {i}") for i in range(6)]
    got = texts(spark, [(f"http://h/{i}", p) for i, p in enumerate(pages)])
    assert got == [tp.main_text(p, None).replace("Tell your friends ", "") for p in pages]
    assert got != [tp.main_text(p, None) for p in pages]


def test_headings_and_paragraphs_of_an_article_stay(spark):
    """Headings on every page, versions of one article, and a long notice: what articles are written in is never dropped."""
    weekly = ["<article><h1>Weekly report</h1><p>own {i} a</p><h2>Ingredients</h2><p>own {i} b</p><ul><li>salt</ul></article>".replace("{i}", str(i)) for i in range(4)]
    assert texts(spark, [(f"http://h/{i}", p) for i, p in enumerate(weekly)]) == [f"Weekly report own {i} a Ingredients own {i} b salt" for i in range(4)]
    versions = ["<article><h1>Title</h1><p>" + "the same long story " * 9 + f"</p><p>as of {i}</p></article>" for i in range(5)]
    assert texts(spark, [(f"http://h/{i}", p) for i, p in enumerate(versions)]) == [tp.main_text(p, None) for p in versions]
    long = ["<article><p>" + "long notice " * 500 + f"</p><p>own {i}</p><div class=x1>Tell your friends</div></article>" for i in range(4)]
    assert texts(spark, [(f"http://h/{i}", p) for i, p in enumerate(long)]) == ["long notice " * 500 + f"own {i}" for i in range(4)]


@pytest.mark.parametrize("inside", [
    "<section id='related-work'>{}</section>", "<div class='market-share'>{}</div>", "<div class='ad-hoc'>{}</div>", "<dl class='promotion-rules'><dd>{}</dl>",
    "<section id='discussion'>{}</section>", "<p class='search'>{}</p>", "<div class='form-of-address'>{}</div>", "<section id=related>{}</section>",
])
def test_names_that_say_something_else_stay_in_an_article(inside):
    assert tp.main_text(f"<article><p>a</p>{inside.format('kept')}<p>b</p></article>", None) == "a kept b"


@pytest.mark.parametrize("inside", [
    "<div class='ad'>{}</div>", "<div class='post-comments'>{}</div>", "<div id='comment-list'>{}</div>", "<div class='cookie-notice'>{}</div>", "<ul class='share-buttons'><li>{}</ul>",
    "<div class='related-posts'>{}</div>", "<aside>{}</aside>", "<form>{}</form>", "<div class='newsletter-signup box'>{}</div>", "<div class='right-sidebar'>{}</div>", "<div hidden>{}</div>", "<div class='ad_unit_2'>{}</div>",
])
def test_names_of_other_things_go_from_an_article(inside):
    assert tp.main_text(f"<article><p>a</p>{inside.format('gone')}<p>b</p></article>", None) == "a b"
