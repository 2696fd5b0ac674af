import datetime as dt
import time

from pyspark.sql import functions as F

from coverlens.functions import html, markup

V = F.col("v")
PAGE = """<!DOCTYPE html><html><head><meta charset="utf-8"><title> A &amp; B
 title </title><style>p{}</style><script>var t="</p><article>no</article>";</script>
<meta name="author" content="Ann Lee"><meta content='Bo &quot;B&quot; Ray' property='article:author'>
<META NAME="author" CONTENT="Ann Lee"><meta property="og:image" content="https://x.org/a.png?a=1&amp;b=2">
<meta property="article:published_time" content="2024-02-15T14:30:00-05:00"></head>
<body><nav><a>Menu</a></nav><!-- <article>hidden</article> --><div class="ad">Buy!</div>
<article class="main"><header>Top bar</header><h1>Head</h1><p>First <b>bold</b> text &copy; 2024.</p><p>Second&nbsp;one.<br>Third &#8212; &lt;b&gt; &amp;copy;.</p>
<aside>Related</aside></article><footer>Legal</footer></body></html>"""


def body(c):
    return html.parts(c)["text"]


def test_title(column):
    assert column([PAGE, "<h1>Only <i>heading</i></h1>", "<p>x</p>", ""], html.decode_references(html.raw_title(V))) == [
        "A & B title", "Only heading", "", ""]


def test_body_keeps_paragraphs_and_drops_boilerplate(column):
    got = column([PAGE], body(V))
    assert got == ["Top bar\n\nHead\n\nFirst bold text \xa9 2024.\n\nSecond\xa0one.\n\nThird — <b> &copy;."]


def test_body_without_article_or_closing_tags(column):
    got = column(["<html><head><title>t</title></head><body><p>One<p>Two</body>", "<p>Loose text", "plain", "",
                  "<body><script>x()</script></body>", "<div>a<script>never closed"], body(V))
    assert got == ["One\n\nTwo", "Loose text", "plain", "", "", "anever closed"]


def test_references_are_decoded_once(column):
    assert column(["cut off&amp", "&copy 2024 &ampcopy;"], html.decode_references(V)) == ["cut off&", "\xa9 2024 &copy;"]
    given = ["&amp;lt;", "&lt;", "&euro;5", "&#x41;&#66;", "AT&T", "&amp;euro;", None, "a &copy; b"]
    assert column(given, html.decode_references(V)) == ["&lt;", "<", "€5", "AB", "AT&T", "&euro;", None, "a \xa9 b"]


def test_meta_fields(column):
    tags = html.meta_tags(V)
    assert column([PAGE, "<p>x</p>"], html.byline(tags)) == ['Ann Lee, Bo "B" Ray', ""]
    assert column([PAGE, "<p>x</p>"], html.top_image(tags)) == ["https://x.org/a.png?a=1&b=2", ""]
    pages = [PAGE, "<time class='t' datetime='2023-12-05'>5 Dec</time>", "<meta name='date' content='soon'>",
             "<meta name='pubdate' content='2/15/24'>", "<meta name='date' content='2024-13-45'>", ""]
    assert column(pages, html.publish_date(tags, html.parts(V)["times"])) == [
        dt.datetime(2024, 2, 15, 14, 30), dt.datetime(2023, 12, 5), None, dt.datetime(2024, 2, 15), None, None]


def test_bylines_in_markup(column):
    pages = ['<p class="byline">By <b>Ann Lee</b> and Bo Ray, Cy Dee</p>', "<a href='/x' rel='author'>Ann Lee</a><a rel=\"author\">Ann Lee</a>",
             "<meta name='author' content='By Ann Lee'><span itemprop='author'>Ann Lee</span><div id='byline'>from: Bo</div>", "<p class='by'>No</p>"]
    assert column(pages, html.byline(html.meta_tags(V), html.parts(V)["bylines"])) == ["Ann Lee, Bo Ray, Cy Dee", "Ann Lee", "Ann Lee, Bo", ""]


def test_url_date(column):
    urls = ["https://a.org/2024/02/15/story", "https://a.org/news/2024-2-5", "https://a.org/2024/13/45/x", "https://a.org/en/825?page=2", "https://a.org/2024/02"]
    assert column(urls, html.url_date(V)) == [dt.datetime(2024, 2, 15), dt.datetime(2024, 2, 5), None, None, None]


def test_links_and_lead_image(column):
    url = F.lit("https://a.org/x/y?q#f")
    links = ["https://b.org/i.png", "//c.org/i.png", "/i.png", "i.png", "", "data:abc"]
    assert column(links, html.absolute(V, url)) == [
        "https://b.org/i.png", "https://c.org/i.png", "https://a.org/i.png", "https://a.org/x/i.png", "", "data:abc"]
    assert column(["i.png"], html.absolute(V, F.lit("https://a.org"))) == ["https://a.org/i.png"]
    tags = html.meta_tags(V)
    pages = ["<p><img alt='x' src='/one.png'><img src='two.png'></p>", "<meta property='og:image' content='/lead.png'><img src='one.png'>", "<p>x</p>"]
    assert column(pages, html.top_image(tags, html.parts(V)["image"], url)) == ["https://a.org/one.png", "https://a.org/lead.png", ""]


def test_page_domain(column):
    urls = ["https://www.Example.org/a?b", "http://u:p@News.example.com:8080#x", "m.example.com/a", "", None, "https://www2.a.net"]
    assert column(urls, html.page_domain(V)) == ["example.org", "news.example.com", "", "", None, "www2.a.net"]
    assert column(urls[:1], html.page_domain(V, keep_www=True)) == ["www.example.org"]


def test_article_records_never_fail_and_never_drop_a_page(spark):
    pages = spark.createDataFrame(
        [("1", "u1", PAGE), ("2", "u2", ""), ("3", "u3", None), ("4", "u4", "<html><body><nav>x</nav></body></html>"),
         ("5", "u5", "<p>broken <b>html")], "id string, url string, html string")
    stamp = F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")
    got = {r["story_id"]: r for r in html.article_records(pages, stamp).collect()}
    assert len(got) == 5
    ok = got["1"]
    assert (ok["success"], ok["error"], ok["title"], ok["authors"]) == (True, None, "A & B title", 'Ann Lee, Bo "B" Ray')
    assert ok["publish_date"] == dt.datetime(2024, 2, 15, 14, 30) and ok["import_date"] == dt.datetime(2024, 1, 1)
    assert ok["summary"].startswith("Top bar")
    for key, error in (("2", "no page"), ("3", "no page"), ("4", "no body text")):
        r = got[key]
        assert (r["success"], r["error"], r["text"], r["title"], r["authors"], r["top_image"], r["summary"]) == (
            False, error, "", "", "", "", "")
    assert got["5"]["text"] == "broken html" and got["5"]["success"]


def test_large_page_does_not_overflow(column):
    page = "<body><article>" + "<p>some text " * 60_000 + "<script>" + "x" * 500_000 + "</script></article></body>"
    got = column([page], F.length(body(V)))
    assert got == [60_000 * len("some text") + 59_999 * 2]


def test_nothing_of_an_article_is_lost(column):
    given = ["<form><p>One.</p><select><option>a</select></form>", "<article>A<article>B</article>Tail</article>",
             "<article>A</article><nav>x</nav><article>B</article>", "<article><header>Lead</header>A</article><header>Top</header>",
             "<article>A<div class='ad'><div>x</div>y</div>B</article>", "<article><nav>A never closed</article>",
             "<article>Teaser</article><div>" + "long text " * 20 + "</div>", "a < b <p>c", "<p>x<!-- y"]
    assert column(given, body(V)) == ["One.", "A\n\nB\n\nTail", "A\n\nB", "Lead\n\nA", "A\n\nB", "A never closed",
                                      "Teaser\n\n" + ("long text " * 20).strip(), "a < b\n\nc", "x y"]


def test_time_grows_with_the_page(column):
    for tag in ("<nav>", "<script>", "<!--", "<div class='byline'>", "<", "<a b"):
        start = time.perf_counter()
        markup.page_parts("<p>text " + tag * (280_000 // len(tag)))
        assert time.perf_counter() - start < 2


def test_attribute_values_keep_their_parameters(column):
    page = '<meta property="og:image" content="https://x.org/a.png?a=1&copy=2&amp;zz=3">'
    assert column([page], html.top_image(html.meta_tags(V))) == ["https://x.org/a.png?a=1&copy=2&zz=3"]


def test_summary_covers_the_whole_text():
    filler = ["Nothing here.", "Also short.", "Quite plain."]
    told = ["The harbour bridge opened again.", "Engineers checked the harbour bridge."]
    assert markup.summarise("Harbour bridge", [*filler, *told, "So it goes."]) == "Nothing here. " + " ".join(told)
    assert markup.summarise("", []) == ""
