"""Download manifests from HTML index pages.

* :func:`extract_links` – every ``href="…"`` (case-insensitive) whose target matches a suffix
  (``.zip`` by default), resolved against the page URL, distinct and sorted. Whole HTML texts are
  scanned with the built-in ``regexp_extract_all``; one page is one row, so pages spread over
  all tasks.
* :func:`select_sources` – case-insensitive regex filter on the URL, sorted, first ``n``.
* :func:`pending_sources` – sources whose name is not yet in a done-manifest (anti join).

URL resolution follows the standard rules (RFC 3986): absolute, scheme-relative (``//host/…``),
root-relative (``/…``), query-only (``?…``), fragment-only (``#…``) and relative (``name``) links; the
dot segments of a relative link's path are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .schema import INGEST_BASE_RULES, detect_base

# Link pattern (the suffix is a parameter) and URL parts.
ZIP_SUFFIX = r"\.zip"
ORIGIN = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"
SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
DIRECTORY = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^?#]*/)"


def href_pattern(suffix: str = ZIP_SUFFIX) -> str:
    return rf'(?i)href="([^"]+{suffix})"'


def without_dots(path: Column) -> Column:
    """An absolute path without its ``.`` and ``..`` segments: each ``..`` takes the segment before it."""
    parts = F.split(F.substring(path, F.lit(2), F.length(path)), "/", -1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: (
        F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
        .when(p == ".", done).otherwise(F.concat(done, F.array(p)))))
    # a path that ends in a dot segment ends in a slash
    slash = F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), slash)


def resolve(href: Column, base_url: Column) -> Column:
    origin = F.regexp_extract(base_url, ORIGIN, 1)
    scheme = F.regexp_extract(base_url, SCHEME, 1)
    directory = F.regexp_extract(base_url, DIRECTORY, 1)
    folder = F.when(directory != "", F.substring(directory, F.length(origin) + 1, F.length(directory))).otherwise(F.lit("/"))
    path = F.regexp_extract(href, r"^[^?#]*", 0)
    rest = F.substring(href, F.length(path) + 1, F.length(href))
    whole = F.when(href.startswith("/"), path).otherwise(F.concat(folder, path))
    return (F.when(href == "", base_url)
            .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("?"), F.concat(F.regexp_extract(base_url, r"^[^?#]*", 0), href))
            .when(href.startswith("#"), F.concat(F.regexp_extract(base_url, r"^[^#]*", 0), href))
            # the rule for dots costs a pass over the segments: only paths that have any pay it
            .when(whole.rlike(r"/\.\.?(/|$)"), F.concat(origin, without_dots(whole), rest))
            .otherwise(F.concat(origin, whole, rest)))


def page_links(pages: DataFrame, suffix: str = ZIP_SUFFIX, html: str = "html", url: str = "url") -> DataFrame:
    """One row per (page, link) occurrence."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(href_pattern(suffix)), 1)
    return (pages.select(F.col(url).alias("page_url"), F.explode(hrefs).alias("href"))
            .select("page_url", "href", resolve(F.col("href"), F.col("page_url")).alias("link")))


def file_name(link: Column) -> Column:
    """Last path segment, without query or fragment (no backtracking regex)."""
    return F.substring_index(F.regexp_replace(link, r"[?#].*", ""), "/", -1)


def extract_links(pages: DataFrame, suffix: str = ZIP_SUFFIX, **kw) -> DataFrame:
    """Distinct resolved links, sorted, with their file name and detected base."""
    links = page_links(pages, suffix, **kw).select("link").distinct()
    # the name is projected first: the base test reads it many times (once per keyword)
    named = links.select("link", file_name(F.col("link")).alias("file_name"))
    return (named.select("link", "file_name", detect_base(F.col("file_name"), INGEST_BASE_RULES).alias("base"))
            .orderBy("link"))


class NoLinksError(RuntimeError):
    pass


def require_links(links: DataFrame) -> DataFrame:
    """``links``, or an error when there are none: an index page without links is a changed page."""
    if links.isEmpty():
        raise NoLinksError("no matching link on the index pages")
    return links


def select_sources(links: DataFrame, pattern: str | None = None, limit: int | None = None) -> DataFrame:
    out = links.where(F.col("link").rlike("(?i)" + pattern)) if pattern else links
    out = out.orderBy("link")
    return out.limit(int(limit)) if limit and limit > 0 else out


def pending_sources(links: DataFrame, done: DataFrame, key: str = "file_name") -> DataFrame:
    return links.join(done.select(key).distinct(), key, "left_anti").orderBy("link")
