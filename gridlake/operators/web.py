"""Links and metadata of stored web pages, with JVM-side patterns over the whole page text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.functions.scalar import as_column, iso_date, strip, unescape, unnest

# What an article path looks like, and first path segments that are not articles.
ARTICLE_PATH = r"^/([a-z0-9]+(?:-[a-z0-9]+){2,})/?$"
EXCLUDED_SEGMENTS = ["categorie", "tag", "auteur", "cdn-cgi", "images", "_next", "api", "mentions-legales"]

# Text that looks like markup but is not: comments, scripts, styles.
_NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# Body of a start tag. Possessive loops keep the matcher from recursing on long tags.
_TAG_BODY = r"[^>\"']*+(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*+)*+"
_VALUE = r"(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"


def markup(html: Column | str) -> Column:
    return F.regexp_replace(as_column(html), _NOT_MARKUP, "")


def tags(html: Column | str, name: str) -> Column:
    """All start tags of one kind, as text, in page order."""
    return F.regexp_extract_all(markup(html), F.lit(rf"(?is)<{name}(?=[\s/]){_TAG_BODY}>"), F.lit(0))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute of a start tag as written: any quoting, any position; empty when absent."""
    other = rf"(?:\s+(?!{name}\s*=)[^\s=>\"']+(?:\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?)*+"
    quoted = F.regexp_extract(tag, rf"(?is)^<\w+{other}\s+{name}\s*=\s*{_VALUE}", 1)
    return F.regexp_replace(quoted, r"""^["']|["']$""", "")


def extract_links(pages: DataFrame, html: str, base: str, page: str, keep: list[str] | None = None) -> DataFrame:
    """Distinct root-relative link targets of each page, the site's own address removed.

    Gives the path, the absolute address and the columns to `keep`. Each page is one row, so its links are made distinct inside
    the row and nothing is shuffled.
    """
    hrefs = F.transform(tags(html, "a"), lambda tag: attribute(tag, "href"))
    paths = F.array_distinct(F.transform(hrefs, lambda h: _own_path(unescape(h), base)))
    rooted = F.filter(paths, lambda path: F.startswith(path, F.lit("/")))
    found = unnest(pages, [page, *(keep or [])], rooted, "_pos", "path")
    return found.select(page, "path", F.concat(F.lit(base), "path").alias("link"), *(keep or []))


def _own_path(href: Column, base: str) -> Column:
    return F.when(F.startswith(href, F.lit(base)), F.substr(href, F.lit(len(base) + 1))).otherwise(href)


def first_segment(path: Column | str) -> Column:
    return F.split_part(strip(path, "/"), F.lit("/"), F.lit(1))


def filter_links(links: DataFrame, pattern: str = ARTICLE_PATH, excluded: list[str] | None = None) -> DataFrame:
    """Links whose path matches the pattern, without the excluded first segments."""
    excluded = EXCLUDED_SEGMENTS if excluded is None else excluded
    return links.filter(F.rlike("path", F.lit(pattern)) & ~first_segment("path").isin(*excluded))


# The meta tags that are read. Other tags are set aside before their attributes are parsed.
META_NAMES = ["og:title", "article:published_time", "description"]


def meta_tags(html: Column | str) -> Column:
    """The meta tags that may be read, as structs of their attributes."""
    wanted = F.filter(tags(html, "meta"), lambda tag: F.rlike(tag, F.lit("|".join(META_NAMES))))
    return F.transform(
        wanted, lambda tag: F.struct(*[attribute(tag, a).alias(a) for a in ("property", "name", "content")])
    )


def _meta(metas: Column, key: str, name: str) -> Column:
    """Content of the first meta tag with the given key, as written; empty counts as absent."""
    first = F.get(F.filter(metas, lambda tag: tag[key] == name), F.lit(0))
    return F.nullif(first["content"], F.lit(""))


def title_element(html: Column | str) -> Column:
    """Text of the title element, as written; NULL when absent or empty."""
    return F.nullif(F.regexp_extract(markup(html), r"(?is)<title[^>]*>(.*?)</title\s*>", 1), F.lit(""))


def page_meta(
    pages: DataFrame, url: str, html: str, as_of: Column, title_fallback: bool = False, keep: list[str] | None = None,
    untitled: bool = False,
) -> DataFrame:
    """Title, publication date and summary from meta tags. Pages without a title are dropped, or with `untitled`
    kept with a NULL title; a page without a date gets the date of `as_of`. With `title_fallback` the title element
    serves when the meta title is missing."""
    metas = F.col("_metas")
    title = _meta(metas, "property", "og:title")
    if title_fallback:
        title = F.coalesce(title, title_element(html))
    raw = pages.withColumn("_metas", meta_tags(html)).select(
        F.col(url).alias("url_source"),
        _meta(metas, "property", "article:published_time").alias("_date"),
        title.alias("_title"),
        _meta(metas, "name", "description").alias("_summary"),
        *(keep or []),
    )
    found = raw.select(
        "url_source",
        F.coalesce(iso_date("_date"), F.to_date(as_of)).alias("date_publication"),
        F.nullif(strip(unescape("_title")), F.lit("")).alias("titre"),
        strip(unescape("_summary")).alias("contenu_resume"),
        *(keep or []),
    )
    return found if untitled else found.filter(F.col("titre").isNotNull())


def frontier(
    links: DataFrame, listing: DataFrame, page: str, link: str, max_pages: int | None = None
) -> DataFrame:
    """Per listing page, in order: links found and links not seen on an earlier page, up to and including
    the first page that brings none (`reached`). A link is new on the first page that shows it.

    `links` is distinct per page, as `extract_links` gives it, and read twice: a written table saves parsing the
    pages again. `listing` has one row per page, also for pages without links.
    """
    found = links.groupBy(page).agg(F.count("*").alias("found"))
    fresh = links.groupBy(link).agg(F.min(page).alias(page)).groupBy(page).agg(F.count("*").alias("new"))
    per_page = (
        listing.select(page)
        .join(found, page, "left")
        .join(fresh, page, "left")
        .fillna(0, ["found", "new"])
    )
    if max_pages is not None:
        per_page = top_pages(per_page, page, max_pages)
    stop = per_page.filter(F.col("new") == 0).agg(F.min(page).alias("p")).select("p").scalar()
    return per_page.filter(stop.isNull() | (F.col(page) <= stop))


def top_pages(per_page: DataFrame, page: str, max_pages: int) -> DataFrame:
    """The first pages of the listing: the crawler's own limit."""
    return per_page.orderBy(page).limit(max_pages)


def crawl_links(links: DataFrame, reached: DataFrame, page: str, link: str) -> DataFrame:
    """Distinct links collected from the pages the crawl reached."""
    return links.join(reached.select(page), page, "left_semi").select(link).distinct()
