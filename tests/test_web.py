"""Page parsing on hand-made markup."""

from datetime import date

from pyspark.sql import functions as F

from gridlake.operators import web

BASE = "https://site.example"


def links(spark, html):
    df = spark.createDataFrame([(1, html)], "id int, html string")
    return sorted(r.path for r in web.extract_links(df, "html", BASE, "id").collect())


def test_links_in_any_writing(spark):
    html = """<A HREF='/one-two-three/'>x</A> <a class="a > b" href="/four-five-six">y</a>
    <a data-href="/no" href=/bare-word-link>z</a> <a title="href='/not-this'" href="/this">t</a>
    <a href="https://site.example/own-site-link">o</a> <a href="https://other.example/x">e</a>
    <a href="relative">r</a> <a href="/a&amp;b&#47;c">n</a> <a name="anchor">q</a> <a href="">w</a>
    <abbr href="/not-a-link">k</abbr> <!-- <a href="/commented">c</a> --> <script>"<a href='/script'>"</script>
    <a
      href = "/spaced" >s</a> <a href="/four-five-six">again</a>"""
    assert links(spark, html) == [
        "/a&b/c", "/bare-word-link", "/four-five-six", "/one-two-three/", "/own-site-link", "/spaced", "/this"]
    assert links(spark, "") == links(spark, None) == []


def test_very_long_tag_does_not_break_the_matcher(spark):
    html = '<a title="' + "x" * 200_000 + '" ' + " ".join(f'data-{i}="{i}"' for i in range(3000)) + ' href="/found">'
    assert links(spark, html) == ["/found"]


def test_article_filter(spark):
    paths = ["/one-two-three/", "/one-two", "/tag/a-b-c", "/categorie", "/a-b-c/d", "/A-b-c", "/images-of-energy", "/tag-a-b"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert sorted(r.path for r in web.filter_links(df).collect()) == ["/images-of-energy", "/one-two-three/", "/tag-a-b"]


def meta(spark, html, **kw):
    df = spark.createDataFrame([("u", html)], "url string, html string")
    return [tuple(r)[1:] for r in web.page_meta(df, "url", "html", F.lit(date(2026, 2, 1)), **kw).collect()]


def test_meta_tags(spark):
    head = '<meta property="og:title" content=" L&#39;&eacute;nergie &amp;amp; co ">'
    assert meta(spark, head) == [(date(2026, 2, 1), "L'énergie &amp; co", None)]
    swapped = "<META content='T' PROPERTY='og:title'/><meta content=\"2026-01-04T23:30:00Z\" property=\"article:published_time\">"
    assert meta(spark, swapped + '<meta name="description" content="a > b">') == [(date(2026, 1, 4), "T", "a > b")]
    assert meta(spark, '<meta property="og:title" content="   ">') == []
    assert meta(spark, '<meta property="og:title">') == meta(spark, None) == []
    assert meta(spark, "<title> Only &copy; </title>") == []
    assert meta(spark, "<title> Only &copy; </title>", title_fallback=True) == [(date(2026, 2, 1), "Only ©", None)]
    bad_date = '<meta property="og:title" content="t"><meta property="article:published_time" content="soon">'
    assert meta(spark, bad_date) == [(date(2026, 2, 1), "t", None)]


def test_frontier_stops_at_the_first_page_without_news(spark):
    pages = spark.createDataFrame([(i,) for i in range(6)], "page int")
    data = [(0, "a"), (0, "b"), (1, "b"), (1, "c"), (2, "a"), (2, "c"), (3, "z")]
    found = spark.createDataFrame(data, "page int, link string")
    reached = web.frontier(found, pages, "page", "link")
    assert sorted(tuple(r) for r in reached.collect()) == [(0, 2, 2), (1, 2, 1), (2, 2, 0)]
    assert sorted(r.link for r in web.crawl_links(found, reached, "page", "link").collect()) == ["a", "b", "c"]
    first = web.frontier(found, pages, "page", "link", max_pages=2)
    assert sorted(r.page for r in first.collect()) == [0, 1]
