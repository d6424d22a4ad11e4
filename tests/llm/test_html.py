from __future__ import annotations

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from forumlens.llm import html_text
from forumlens.llm import wrappers as wr

PAGE = "page_id long, url string, html string"


def nodes(text):
    return wr.page_nodes(wr.read_page(text))


def test_stream():
    page = wr.read_page(
        "<!DOCTYPE html><!-- no --><body CLASS='x Y1'><script>var a='<p>no</p>';</script><p>One&nbsp; <b>two</b>&amp;lt;\n three<br>four<p>five"
        "<a href=x title='a>b'>six</a><hr/>a < b<style>p{}</style><div unfinished"
    )
    assert page.symbols == ["body x y", "p", "#", "/p", "p", "#", "/p", "hr", "#"]
    assert page.texts == ["One two&lt; three four", "fivesix", "a < b"]
    assert page.linked == [0, 3, 0]


def test_repeated_groups_and_slots():
    page = nodes("<ul><li>a</li><li>b</li><li>b</li></ul><p>x</p><p>x</p>")
    assert wr.show(page) == "<ul>(<li>#text</li>)+</ul>(<p>#text</p>)+"
    first, second = wr.slots(page)
    assert first.same is None and second.same is not None and first.places == [0, 1, 2]


def test_optional_parts_and_single_runs():
    merged = wr.merge(nodes("<h1>a</h1><p>x</p><p>y</p><i>z</i><hr>"), nodes("<h1>a</h1><h2>b</h2><p>x</p>"))
    assert wr.show(merged) == "<h1>#text</h1>(<h2>)?(#text)?(</h2>)?(<p>#text</p>)+(#text)?(<hr>)?"
    assert wr.slots(merged)[0].same is not None
    assert wr.show(wr.load(wr.dump(merged))) == wr.show(merged)


def test_wrapper_takes_both_pages():
    a, b = "<div><p>1</p><p>2</p></div><em>k</em>", "<div><p>3</p></div>"
    wrapper = wr.merge(nodes(a), nodes(b))
    for text in (a, b):
        page = nodes(text)
        flags = wr.flags_of(page, wr.load(wr.dump(wrapper)), [True] * len(wr.slots(wrapper)), [False] * len(wr.slots(page)))
        assert all(f for _, f in flags)


def extracted(spark, *rows):
    return {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, PAGE)).collect()}


def test_main_text_of_other_layouts(spark):
    body = (
        "<body><header><h2>Site</h2></header><div id='cookie-notice'>We use cookies</div><div class='sidebar'><p>Side</p></div>"
        "<main><h1>Title {0}</h1><div class='share'>Share</div><p>Text {0} &eacute;.</p><form><p>Name</p><input></form><ul><li>one {0}</li><li>two</li></ul>"
        "<table><tr><td>cell {0}</td></tr></table><aside>Aside</aside><section id='comments'><article><p>Comment {0}</p></article></section></main>"
        "<footer>Foot</footer></body>"
    )
    found = extracted(spark, *[(i, f"http://a.example/{i}", body.format(i)) for i in range(4)])
    assert found == {i: f"Title {i}\nText {i} é.\none {i}\ntwo\ncell {i}" for i in range(4)}


def test_text_without_content_elements(spark):
    """The template's own text and lists of links go; what differs between pages stays."""
    page = "<body><div><a href=/>Home</a> <a href=/x>News {0}</a></div><p>Welcome to our site</p><div>Story number {0}.</div></body>"
    found = extracted(spark, *[(i, f"http://b.example/{i}", page.format("abc"[i])) for i in range(3)])
    assert found == {i: f"Story number {'abc'[i]}." for i in range(3)}


def test_hosts_of_mixed_layouts(spark):
    """Each page is judged by its own best level; the wrapper only takes away constant text."""
    layouts = {
        "article": ("<body><article><p>Story {0}</p></article></body>", "Story {0}"),
        "main": ("<body><main><ul><li>first {0}</li><li>second {0}</li></ul></main></body>", "first {0}\nsecond {0}"),
        "named": ("<body><div class=content><h2>Head {0}</h2></div></body>", "Head {0}"),
        "body": ("<body><div><p>Plain {0}</p><hr></div></body>", "Plain {0}"),
    }
    rows, want = [], {}
    for k, url in enumerate(("http://mixed.example/", "no host")):
        for j, (html_, text) in enumerate(layouts.values()):
            for i in range(3 if j else 1):
                n = 100 * k + 10 * j + i
                rows.append((n, url, html_.format(n)))
                want[n] = text.format(n)
    assert extracted(spark, *rows) == want


def test_names_of_the_outermost_elements_are_no_boilerplate(spark):
    page = "<html class='no-js cookies'><body class='has-sidebar header'><main class='widget'><p>Text {0}</p><article class=related><p>Other {0}</p></article></main></body></html>"
    assert extracted(spark, *[(i, "http://n.example/", page.format(i)) for i in range(3)]) == {i: f"Text {i}" for i in range(3)}
    page = "<body class=newsletter><article class=sponsored><p>Paid {0}</p></article></body>"
    assert extracted(spark, *[(i, "http://s.example/", page.format(i)) for i in range(3)]) == {i: f"Paid {i}" for i in range(3)}


def test_constant_text_goes_outside_content_elements_but_leaves_no_page_empty(spark):
    page = "<body><div>Welcome to our site</div><p>Text {0}</p><div>Read this every day</div></body>"
    rows = [(i, "http://e.example/", page.format(i)) for i in range(4)]
    assert extracted(spark, *rows) == {i: f"Text {i}" for i in range(4)}
    copies = [(i, "http://f.example/", page.format(0)) for i in range(4)]
    assert extracted(spark, *copies) == {i: "Welcome to our site\nText 0\nRead this every day" for i in range(4)}
    # Text of one page alone is its own
    single = [*[(i, "http://g.example/", f"<body><p>Plain {i}</p></body>") for i in range(3)], (9, "http://g.example/", "<body><p>Plain 9</p><h2>Once</h2></body>")]
    assert extracted(spark, *single)[9] == "Plain 9\nOnce"
    # A heading that recurs in articles is theirs on hosts of any size
    article = "<body><article><h1>Title {0}</h1><p>Text {0}</p><h3>Read this every day</h3></article></body>"
    for n in (2, 4, 9):
        assert extracted(spark, *[(i, "http://h.example/", article.format(i)) for i in range(n)]) == {i: f"Title {i}\nText {i}\nRead this every day" for i in range(n)}


PAGES = [
    ("<div class='layout no-sidebar'><p>Body text.</p></div>", "Body text."),
    ("<div id='page' class='has-banner'><p>Body text.</p></div>", "Body text."),
    ("<div class='site with-nav'><article><p>Body text.</p></article></div>", "Body text."),
    ("<div class='site-nav'><p>Home</p></div><p>Body text.</p>", "Body text."),
    ("<form id=aspnet><p>All of the body text lies here.</p></form><p>Foot</p>", "All of the body text lies here.\nFoot"),
    ("<p>All of the body text lies here.</p><form><p>Your mail</p></form>", "All of the body text lies here."),
    ("<main><p>Intro</p><article><p>Story</p></article><p>Outro</p></main>", "Intro\nStory\nOutro"),
    ("<article><p>Teaser</p></article><main><h1>Story</h1><p>Long text</p></main>", "Story\nLong text"),
    ("<p title=it's>He said it's fine.</p><p>More 'text'.</p>", "He said it's fine.\nMore 'text'."),
    ("<p title='a > b' data-x=\"'\">Quoted.</p>", "Quoted."),
    ("<p title=\"class='sidebar'\">Named in a title.</p>", "Named in a title."),
    ("<p>Before</p><svg/><p>After</p><svg width='1'><text>drawn</text></svg><p>End</p>", "Before\nAfter\nEnd"),
    ("<p class=\"open>Text</p><p>More</p>", "Text\nMore"),
]


def test_layouts_that_names_or_quotes_tell_wrongly(spark):
    rows = [(i, f"http://p{i}.example/", html) for i, (html, _) in enumerate(PAGES)]
    assert extracted(spark, *rows) == {i: text for i, (_, text) in enumerate(PAGES)}


def test_very_many_names(spark):
    letters = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    page = "".join(f"<p class=x{letters(i)}>t</p>" for i in range(140_000))
    nodes = wr.page_nodes(wr.read_page(page))
    assert len(wr.slots(nodes)) == 140_000
    many = wr.LETTERS
    try:
        wr.LETTERS = 10
        assert wr.show(wr.page_nodes(wr.read_page(page[:2000] + "<b>x</b>" + "<i></i><hr>" * 3))).endswith("(<hr>)+")
    finally:
        wr.LETTERS = many


def test_given_pages(spark, sample):
    pages = spark.read.parquet(f"{sample}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "" if x else " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article) for x in (0,)]
        assert found[r.page_id] == "\n".join(b for b in blocks if b)


def test_order_of_pages_does_not_matter(spark):
    draw = random.Random(3)
    rows = [(i, "http://c.example/", "<div>" + "<p>t</p>" * draw.randint(0, 5) + "<hr>" * draw.randint(0, 2) + "<h2>u</h2>" * draw.randint(0, 1) + "</div>") for i in range(40)]
    wrappers = set()
    for _ in range(2):
        draw.shuffle(rows)
        wrappers.add(html_text.infer(spark.createDataFrame(rows, PAGE)).first().wrapper)
    assert len(wrappers) == 1


@pytest.mark.parametrize("given", [None, "", "   ", "plain", "<", "<p", "</p>", "<p>x", "&#x41;&bogus;", "<article></article>", "<script>x"])
def test_any_html_has_a_text(spark, given):
    found = extracted(spark, (1, "u", given))[1]
    assert found == {"plain": "plain", "<": "<", "<p>x": "x", "&#x41;&bogus;": "A&bogus;"}.get(given, "")


def test_odd_rows(spark):
    long = "<article>" + "".join(f"<p>para {i}</p>" for i in range(20_000)) + "</article>"
    rows = [(1, None, "<p>a</p>"), (1, None, "<p>a</p>"), (2, "http://h/", long), (3, "http://h/", "<article><p>b</p></article>"), (None, "no url", "<p>c</p>")]
    pages = spark.createDataFrame(rows, PAGE).withColumn("text", F.lit(1)).withColumn("host", F.lit(2)).withColumn("_wrapper", F.lit(3)).withColumn("pages", F.lit(4))
    found = sorted((r.page_id or 0, r.text) for r in html_text.extract(pages).collect())
    assert [f[1] for f in found if f[0] != 2] == ["c", "a", "a", "b"]
    assert dict(found)[2].count("\n") == 19_999
    assert html_text.extract(pages.where("false")).collect() == []


def test_host(spark):
    urls = ["http://A.example/x", "https://u:p@b.example:80/", "ftp://c?x", "d.example/x", None, ""]
    found = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(html_text.host(F.col("u"))).collect()]
    assert found == ["a.example", "b.example", "c", "", "", ""]
