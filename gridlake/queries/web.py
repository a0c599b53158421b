"""Web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.operators import web
from gridlake.operators.joining import new_only
from gridlake.operators.quality import union_distinct
from gridlake.queries.registry import Tables, query
from gridlake.sources.tables import settled

# The address the test pages' links hang under, and a path pattern that some of them match.
BASE = "https://www.example.com"
PATTERN = "^/[A-Za-z]+$"
EXCLUDED = ["the", "der", "les"]

MARKUP_SQL = r"regexp_replace(html, '<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'gis')"
DECODED_SQL = "replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"
TITLE_SQL = rf"regexp_extract({MARKUP_SQL}, '<title[^>]*>(.*?)</title\s*>', 1, 'is')"
LINKS_SQL = f"""
hrefs AS (SELECT page_id, unnest(regexp_extract_all({MARKUP_SQL}, '(?i)<a\\s[^>]*?href="([^"]*)"', 1)) AS raw FROM pages),
links AS (SELECT DISTINCT page_id, path, '{BASE}' || path AS link FROM (
  SELECT page_id, CASE WHEN starts_with(h, '{BASE}') THEN substr(h, {len(BASE) + 1}) ELSE h END AS path
  FROM (SELECT page_id, {DECODED_SQL.format('raw')} AS h FROM hrefs)) WHERE path LIKE '/%')
"""
FILTERED_SQL = f"""{LINKS_SQL}, kept AS (SELECT * FROM links WHERE regexp_matches(path, '{PATTERN}')
  AND split_part(trim(path, '/'), '/', 1) NOT IN ('the', 'der', 'les'))"""
FRONTIER_SQL = f"""{FILTERED_SQL},
found AS (SELECT page_id, count(*) AS found FROM kept GROUP BY 1),
fresh AS (SELECT page_id, count(*) AS new FROM (SELECT link, min(page_id) AS page_id FROM kept GROUP BY 1) GROUP BY 1),
pp AS (SELECT page_id, coalesce(found, 0) AS found, coalesce(new, 0) AS new FROM pages LEFT JOIN found USING (page_id)
  LEFT JOIN fresh USING (page_id)),
reached AS (SELECT * FROM pp WHERE page_id <= coalesce((SELECT min(page_id) FROM pp WHERE new = 0), page_id))"""


def links(t: Tables) -> DataFrame:
    return web.extract_links(t.pages, "html", BASE, "page_id")


def kept(t: Tables) -> DataFrame:
    return web.filter_links(links(t), PATTERN, EXCLUDED)


def written(t: Tables) -> DataFrame:
    """The kept links as narrow rows, written so that what reads them twice does not parse the pages twice."""
    return settled(kept(t).select("page_id", "link"), "kept_links")


@query(f"WITH {LINKS_SQL} SELECT * FROM links")
def page_links(t: Tables) -> DataFrame:
    return links(t)


@query(f"WITH {FILTERED_SQL} SELECT * FROM kept")
def link_filter(t: Tables) -> DataFrame:
    return kept(t)


@query(
    f"""WITH {LINKS_SQL} SELECT * FROM links WHERE regexp_matches(path, '^/([a-z0-9]+(?:-[a-z0-9]+){{2,}})/?$')
    AND split_part(trim(path, '/'), '/', 1) NOT IN ('categorie', 'tag', 'auteur', 'cdn-cgi', 'images', '_next', 'api', 'mentions-legales')"""
)
def article_links(t: Tables) -> DataFrame:
    """With the default article pattern and exclusions."""
    return web.filter_links(links(t))


ARTICLE_SQL = "lower(replace(o_orderpriority, ' ', '-')) || '-' || o_orderstatus || '-' || CAST(o_orderkey AS {text})"


@query(
    f"""SELECT o_orderkey AS page_id, '/' || lower(a) || CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '' END AS path,
    '{BASE}/' || lower(a) || CASE WHEN o_orderstatus = 'P' THEN '/' ELSE '' END AS link
    FROM (SELECT *, {ARTICLE_SQL.format(text='VARCHAR')} AS a FROM orders) WHERE o_orderstatus <> 'O'"""
)
def article_paths(t: Tables) -> DataFrame:
    """Pages built from orders: articles by path (F) or whole address (P), below a tag (O); each with links that are none."""
    slug = f"lower({ARTICLE_SQL.format(text='STRING')})"
    address = f"CASE o_orderstatus WHEN 'P' THEN '{BASE}/' || {slug} || '/' WHEN 'O' THEN '/tag/' || {slug} ELSE '/' || {slug} END"
    html = F.expr(f"""'<a href="/categorie">c</a> <a class="x" href="' || {address} || '">a</a> <a href="/two-words">b</a>'""")
    pages = t.orders.select(F.col("o_orderkey").alias("page_id"), html.alias("html"))
    return web.filter_links(web.extract_links(pages, "html", BASE, "page_id"))


@query(f"WITH {FRONTIER_SQL} SELECT page_id, found, new FROM reached")
def frontier(t: Tables) -> DataFrame:
    return web.frontier(written(t), t.pages, "page_id", "link")


@query(f"WITH {FRONTIER_SQL} SELECT DISTINCT link FROM kept JOIN reached USING (page_id)")
def crawl_links(t: Tables) -> DataFrame:
    found = written(t)
    return web.crawl_links(found, web.frontier(found, t.pages, "page_id", "link"), "page_id", "link")


LANG_SQL = "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)"


@query(
    f"""WITH {LINKS_SQL}, l AS (SELECT link, {LANG_SQL} AS lang FROM links JOIN pages USING (page_id))
    SELECT DISTINCT link FROM l WHERE lang = 'en' AND link NOT IN (SELECT link FROM l WHERE lang <> 'en')"""
)
def new_links(t: Tables) -> DataFrame:
    """Links of English pages that no other page has."""
    english, others = by_language(t)
    return new_only(english, others, "link").distinct()


@query(f"WITH {LINKS_SQL} SELECT DISTINCT link FROM links")
def union_links(t: Tables) -> DataFrame:
    english, others = by_language(t)
    return union_distinct(english, others)


def by_language(t: Tables) -> tuple[DataFrame, DataFrame]:
    lang = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    pages = t.pages.withColumn("lang", lang)
    tagged = settled(web.extract_links(pages, "html", BASE, "page_id", keep=["lang"]).select("link", "lang"), "tagged_links")
    return tagged.filter(F.col("lang") == "en").select("link"), tagged.filter(F.col("lang") != "en").select("link")


@query(
    f"""SELECT url AS url_source, DATE '2024-02-01' AS date_publication,
    trim({DECODED_SQL.format(TITLE_SQL)}, E' \\t\\r\\n') AS titre, NULL::VARCHAR AS contenu_resume
    FROM pages WHERE {TITLE_SQL} <> ''"""
)
def page_meta(t: Tables) -> DataFrame:
    return web.page_meta(t.pages, "url", "html", F.lit("2024-02-01").cast("date"), title_fallback=True)


META_PAGE = (
    "concat('<html><head><meta content=\"', o_orderpriority, ' &amp; ', o_orderstatus, '\" property=\"og:title\">',"
    " CASE WHEN o_orderstatus = 'F' THEN concat('<meta property=''article:published_time'' content=''', {date}, 'T01:00:00+02:00''>') ELSE '' END,"
    " '<META NAME=\"description\" CONTENT=\"  ', o_orderkey, '  \"></head></html>')"
)


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS url_source,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) ELSE DATE '2002-01-01' END AS date_publication,
    o_orderpriority || ' & ' || o_orderstatus AS titre, CAST(o_orderkey AS VARCHAR) AS contenu_resume FROM orders"""
)
def page_meta_tags(t: Tables) -> DataFrame:
    """Pages with meta tags in either attribute order and quoting, built from orders."""
    html = F.expr(META_PAGE.format(date="date_format(o_orderdate, 'yyyy-MM-dd')"))
    pages = t.orders.select(F.col("o_orderkey").cast("string").alias("url"), html.alias("html"))
    return web.page_meta(pages, "url", "html", F.lit("2002-01-01").cast("date"))
