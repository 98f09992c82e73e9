import pytest
from pyspark.sql import functions as F

from whosaid.functions.html import clean_html, decode_entities, html_tokens, resolve_link
from whosaid.functions.quotations import find_quotations
from whosaid.functions.tokens import fix_content, tokenize_raw

BASE = "http://e.org/d/page"

CLEANED = [
    ("plain & simple", "plain &amp; simple"),
    ("<div>a<b>b</b><i>c</i></div>", "abc"),
    ("<p>one<p>two", "<p>one</p><p>two</p>"),
    ("<p>a<br/>b</p></br>", "<p>a<br>b</p><br>"),
    ("<script>var t='</p>';</script>x<style>p{}</style>", "x"),
    ("<!-- gone -->x<!doctype html>", "x"),
    ("<head lang=en><title>t</title></head><body>x</body>", "x"),
    ("<header>h</header>", "h"),
    ('<a href="/x" onclick="y" title="t">l</a>', '<a href="http://e.org/x" title="t">l</a>'),
    ('<a href="z">l</a>', '<a href="http://e.org/d/z">l</a>'),
    ('<a href="javascript:x()">l</a>', "<a>l</a>"),
    ('<a href="mailto:a@b.c">l</a>', '<a href="mailto:a@b.c">l</a>'),
    ('<q cite="ftp://e.org">l</q>', "<q>l</q>"),
    ('<blockquote cite="c">l</blockquote>', '<blockquote cite="http://e.org/d/c">l</blockquote>'),
    ("&lt;p&gt; &eacute; &nbsp;", "&lt;p&gt; é &nbsp;"),
    ("<section><img src=x>t</section>", "t"),
    ("a<!-- open comment", "a"),
    ("a<script>open", "a"),
    ("a<style type=x>open <p>", "a"),
    (
        "<p>caf&eacute; it&#x27;s &#233;t&#233; &#128512; &#146; &#0; &#xD800; &nosuch; &copy2",
        "<p>café it's été 😀 ’ � � &amp;nosuch; ©2</p>",
    ),
    (
        "<a HREF='../x/./y?q=../z' title='a \"b\"'>",
        '<a href="http://e.org/x/y?q=../z" title="a &quot;b&quot;"></a>',
    ),
    ("<a title='x href=y'>", '<a title="x href=y"></a>'),
    ("<a title>", '<a title=""></a>'),
    ("a < b", "a &lt; b"),
    ("", ""),
    # Elements that stay open, cross each other, or end without a start.
    ("<blockquote>a", "<blockquote>a</blockquote>"),
    ("<div><p>one</div>two", "<p>one</p>two"),
    ("<p>a<div>b</div>c</p>d", "<p>a</p>bcd"),
    ("<p>a<hr>b", "<p>a</p>b"),
    ("<q>a<p>b</q>c", "<q>a<p>bc</p></q>"),
    ("<span><q>a</span>b</q>", "<q>a</q>b"),
    ("<b><q>a</b>b</q>", "<q>a</q>b"),
    ("<ul><li><p>x<li><q>y</ul>z", "<p>x</p><q>y</q>z"),
    ("<li><p>a<ul><li>b</ul>c</li>d", "<p>a</p>bcd"),
    ("<h1>a<h2>b</h1>c", "<h1>a</h1><h2>b</h2>c"),
    ("<a>one<a>two", "<a>one</a><a>two</a>"),
    ("<table><tr><td><p>a<td><q>b<tr><td>c</table>d", "<p>a</p><q>b</q>cd"),
    ("<p><table><td></p>x</table>y", "<p></p>xy"),
    ("</q>x</p></div>", "x"),
    ("<q/>x<p />y", "<q></q>x<p></p>y"),
    ("<a href=/x/>l", '<a href="http://e.org/x/">l</a>'),
    ("<made-up><q>a</made-up>b", "<q>ab</q>"),
    ("<q>" * 300 + "x", "<q>" * 300 + "x" + "</q>" * 300),
    ("<p>" * 1000, "<p></p>" * 1000),
    # Brackets in quotes.
    ('<a href="/x>y">t</a>', '<a href="http://e.org/x>y">t</a>'),
    ("<p title='a<q>b'>t", "<p>t</p>"),
    ('<p title="<!-- x">y', "<p>y</p>"),
    ("<script a='>'>z</script>y", "y"),
    ("<a title=it's>b</a>", "<a title=\"it\">b</a>"),
    ("<a title='x", "&lt;a title='x"),
    (None, None),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    rows = [(i, html, BASE) for i, (html, _) in enumerate(CLEANED)]
    df = spark.createDataFrame(rows, "i int, html string, url string")
    found = df.select("i", clean_html(F.col("html"), F.col("url")).alias("c")).collect()
    return {r.i: r.c for r in found}


@pytest.mark.parametrize("case", range(len(CLEANED)))
def test_clean_html(cleaned, case):
    assert cleaned[case] == CLEANED[case][1]


def test_cleaned_html_stays_as_it_is(spark):
    html = '<h1>t</h1><p>a <a href="http://e.org/x">b &amp; c</a><br>c</p>'
    df = spark.createDataFrame([(html, BASE)], "h string, u string")
    assert df.select(clean_html(F.col("h"), F.col("u")).alias("c")).first().c == html


def test_cleaning_stays_in_the_jvm(spark):
    df = spark.createDataFrame([("x", BASE)], "h string, u string")
    df = df.select(html_tokens(F.col("h"), F.col("u")))
    assert "Python" not in df._jdf.queryExecution().toString()


def test_links_against_the_standard_library(spark):
    from urllib.parse import urljoin

    links = [
        "x", "/x", "//h/x", "?q", "#f", "", "a/../b", "../b", "../../b", "./c", "..", ".",
        "/a/./b/../c", "http://o.org/p", "x?y=../z", "mailto:a@b", "a/b/", "../",
    ]
    bases = ["http://e.org/d/page", "https://e.org", "http://e.org/d/e/?q=1#f", ""]
    rows = [(b, link) for b in bases for link in links]
    df = spark.createDataFrame(rows, "b string, l string")
    found = df.select("b", "l", resolve_link(F.col("b"), F.col("l")).alias("r")).collect()
    for r in found:
        expected = urljoin(r.b, r.l)
        if r.b == "https://e.org" and not r.l.startswith(("?", "#")) and "://" in expected:
            expected = expected if expected.count("/") > 2 or r.l == "" else expected + "/"
        if r.l == "" and "#" in r.b:
            expected = r.b
        assert r.r == expected, (r.b, r.l)


def test_all_named_entities(spark):
    from html import unescape
    from html.entities import html5

    names = [f"&{n}" for n in html5 if n.endswith(";")]
    numbers = [f"&#{n};" for n in (9, 65, 233, 128, 159, 8364, 128512)]
    df = spark.createDataFrame([(n,) for n in names + numbers], "e string")
    for r in df.select("e", decode_entities(F.col("e")).alias("d")).collect():
        assert r.d == unescape(r.e)


@pytest.mark.parametrize(
    "html, expected",
    [
        ("<p>He<b>ll</b>o <i>you</i></p>", ["Hello", "you"]),
        ("<q>a</q><script>x</script>", ["<q>", "a", "</q>"]),
        ('<q cite="http://x">a</q>', ["a", "</q>"]),
        ("&ldquo;well-made&rdquo;", ["``", "well", "-", "made", "''"]),
        ("a<br>b<!-- <q> -->", ["a", "b"]),
        ('<a href="x>y">a</a>', ["a"]),
        ("<blockquote>a<p>b", ["<blockquote>", "a", "b", "</blockquote>"]),
        ("1 &lt; 2", ["1", "2"]),
        ("R&ampD &copy &amp;copy;", ["R", "&", "D", "©", "&", "copy", ";"]),
        ("it&#x27;s &#233;t&#233;<!-- open", ["it", "'s", "été"]),
    ],
)
def test_html_tokens(spark, html, expected):
    df = spark.createDataFrame([(html, BASE)], "h string, u string")
    assert df.select(html_tokens(F.col("h"), F.col("u")).alias("x")).first().x == expected
    steps = fix_content(tokenize_raw(clean_html(F.col("h"), F.col("u"))))
    assert df.select(steps.alias("x")).first().x == expected


def test_a_quotation_that_the_page_leaves_open(spark):
    html = "<div><blockquote>" + " ".join("abcdefghijkl") + "</div> more"
    df = spark.createDataFrame([(html, BASE)], "h string, u string")
    spans = find_quotations(html_tokens(F.col("h"), F.col("u")))
    assert [list(s) for s in df.select(spans.alias("s")).first().s] == [[0, 13]]


def test_a_page_of_many_pieces(spark):
    html = "<div>a<q>b" * 5_000
    df = spark.createDataFrame([(html, BASE)], "h string, u string")
    found = df.select(clean_html(F.col("h"), F.col("u")).alias("c")).first().c
    assert found == "a<q>b" * 5_000 + "</q>" * 5_000
