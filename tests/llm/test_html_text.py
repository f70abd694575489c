import html as entities
import re

import pytest

from corpusmill.llm import html_text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a="<p>no</p>";</script></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a>Menu {0}</a><li>Menu two</ul></nav>
<div class="ad">Buy {0}</div><div class="cookie-notice">We use cookies</div>
{1}<aside>Aside {0}</aside><form>Name <input></form>
<div id="comments"><p>Reader {0} says hello, at some length, again and again and again</p></div>
<footer>&copy; {0}</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'old' AS text", "1 AS host")


def texts(spark, rows):
    df = pages(spark, rows)
    out = html_text.extracted(df)
    assert set(out.columns) == set(df.columns)
    return [r["text"] for r in out.orderBy("page_id").collect()]


def test_article_without_its_surroundings(spark):
    body = "<article><h1>Head &amp; line</h1><p>One\n two<br>three <b>bold<p>Second &eacute;</p><ul><li>a<li>b</ul></article>"
    want = "Head & line\nOne two three bold\nSecond é\na\nb"
    rows = [(i, f"http://h.example/{i}", PAGE.format(i, body)) for i in range(8)]
    assert texts(spark, rows) == [want] * 8
    assert texts(spark, rows[:1]) == [want]


@pytest.mark.parametrize("wrap", ["<main>{}</main>", '<div class="post-content">{}</div>', "<div><div>{}</div></div>"])
def test_slot_without_article_element(spark, wrap):
    rows = [(i, "http://h.example/x", PAGE.format(i, wrap.format(
        f"<h2>Title {i}</h2><p>Text number {i} goes on for a while, as texts do.</p><p>And on {i * 7}, and on.</p>"))) for i in range(6)]
    assert texts(spark, rows) == [f"Title {i}\nText number {i} goes on for a while, as texts do.\nAnd on {i * 7}, and on." for i in range(6)]


def test_constant_text_is_template_but_copies_are_not(spark):
    rows = [(i, "https://a.example/p", f"<body><article><p>Share this story</p><p>Story {i} is told here at length.</p></article></body>") for i in range(6)]
    assert texts(spark, rows) == [f"Story {i} is told here at length." for i in range(6)]
    copies = [(i, "https://b.example/p", "<body><article><p>The same story</p><p>on every page</p></article></body>") for i in range(6)]
    assert texts(spark, copies) == ["The same story\non every page"] * 6


def test_passage_that_most_pages_share_stays(spark):
    shared = "<p>A passage that most pages of this host share.</p>"
    rows = [(i, "https://c.example/p", f"<body><article><p>Share this story</p><p>Story {i} is told here at length, and then it goes on and on.</p>"
             f"{shared if i else ''}</article></body>") for i in range(10)]
    story = [f"Story {i} is told here at length, and then it goes on and on." for i in range(10)]
    assert texts(spark, rows) == [story[0]] + [f"{x}\nA passage that most pages of this host share." for x in story[1:]]


@pytest.mark.parametrize("wrap", [
    '<div class="content has-sidebar">{}</div>', '<article class="post comments-open">{}</article>',
    '<main id="main-no-sidebar">{}</main>', '<div class="menu-open"><article>{}</article></div>',
    '<div class="menu-open"><div class="content">{}</div></div>'])
@pytest.mark.parametrize("n", [1, 8])
def test_label_words_on_what_holds_the_article(spark, wrap, n):
    rows = [(i, "http://t.example/x", PAGE.format(i, wrap.format(
        f"<p>Text number {i} goes on for a while, as texts do, and it is much longer than the comments, adverts and notices "
        f"that stand around it on the page, with {i * 7} more words.</p><div class='share'>Share {i}</div>"))) for i in range(n)]
    assert texts(spark, rows) == [
        f"Text number {i} goes on for a while, as texts do, and it is much longer than the comments, adverts and notices "
        f"that stand around it on the page, with {i * 7} more words." for i in range(n)]


def test_odd_pages(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "plain text &lt;only"), (4, "http://x/", "<p>" + "word " * 60000),
            (5, "http://x/", "<p>unclosed <i>tags <div>and < signs</p"), (6, None, "<script>x</script>"), (7, "http://x/", "<" * 500),
            (8, "http://x/", "<div>" * 300 + "deep" + "</div>" * 300), (None, "http://x/", "<p>a</p>")]
    out = {r["page_id"]: r["text"] for r in html_text.extracted(pages(spark, rows)).collect()}
    assert len(out) == len(rows)
    assert (out[1], out[2], out[3], out[6], out[8], out[None]) == ("", "", "plain text <only", "", "deep", "a")
    assert out[4] == ("word " * 60000).strip()
    assert html_text.extracted(pages(spark, [])).collect() == []


def test_given_pages_by_brute_force(small):
    for r in html_text.extracted(small("pages")).collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [re.sub("</?b>", "", re.sub("<br>", " ", x)) for x in re.split(r"</?(?:h1|p)>", inner)]
        blocks = [re.sub(r"\s+", " ", entities.unescape(x)).strip() for x in blocks]
        assert r["text"] == "\n".join(x for x in blocks if x)


def test_columns_of_one_name_stand_apart(spark):
    """The sidebar has the article column's class but for a digit, no telling name, and varies from page to page."""
    rows = [(i, f"https://grid.example/p{i}", f"<html><body><div class='row'><div class='col-md-8'><p>{f'Story {i} ' * 30}</p></div>"
             f"<div class='col-md-4'><p>Elsewhere {i * 7} today</p></div></div></body></html>") for i in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r["text"] for r in html_text.extracted(df).orderBy("page_id").collect()] == [(f"Story {i} " * 30).strip() for i in range(12)]


def test_clashing_columns(spark):
    page = "<html><body><article><p>Body of it</p></article></body></html>"
    df = spark.createDataFrame([(i, f"https://a.example/{i}", page) for i in range(6)], "page_id long, url string, html string")
    df = df.selectExpr("*", "'p' AS paths", "'t' AS texts", "'h' AS _host", "'x' AS _paths", "'y' AS host", "'z' AS page")
    out = html_text.extracted(df)
    assert out.columns == [*df.columns, "text"]
    assert {(r["text"], r["paths"], r["_host"], r["_paths"], r["host"]) for r in out.collect()} == {("Body of it", "p", "h", "x", "y")}
