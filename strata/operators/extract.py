"""Page extraction.

Regular attributes (title, heading, list links) are pulled with native
``regexp_extract[_all]``: JVM-side, inside whole-stage codegen, and
checkable with SQL. Structural rules (tables, label/value blocks, person
sections) are column expressions too, in ``strata.operators.page_rules``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.text import clean

# Markup patterns for the regular page parts.
TITLE_RE = "<title>([^<]*)</title>"
H1_RE = "<h1>([^<]*)</h1>"
LINK_RE = '<li><a href="([^"]*)">([^<]*)</a></li>'


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def first_match(html, pattern: str) -> Column:
    """First capture of ``pattern``, cleaned; no match -> null."""
    return clean(F.regexp_extract(_c(html), pattern, 1))


def page_summary(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per page: title, h1, number of list links, first link."""
    hrefs = F.regexp_extract_all(F.col(html), F.lit(LINK_RE), 1)
    return pages.select(
        key,
        first_match(html, TITLE_RE).alias("title"),
        first_match(html, H1_RE).alias("h1"),
        F.size(hrefs).cast("bigint").alias("n_links"),
        F.try_element_at(hrefs, F.lit(1)).alias("first_href"),
    )


def link_array(html) -> Column:
    """The page's list links as ``array<struct<href, text>>`` in page order."""
    h = _c(html)
    return F.arrays_zip(F.regexp_extract_all(h, F.lit(LINK_RE), 1).alias("href"),
                        F.regexp_extract_all(h, F.lit(LINK_RE), 2).alias("text"))


def explode_links(df: DataFrame, links: str, keep=("page_id",)) -> DataFrame:
    """One row per link of an ``array<struct<href, text>>`` column, 1-based position."""
    return (df.select(*keep, F.posexplode(links).alias("_p", "_l"))
            .select(*keep, (F.col("_p") + 1).cast("bigint").alias("link_pos"),
                    F.col("_l.href").alias("href"), F.col("_l.text").alias("link_text")))


def page_links(pages: DataFrame, keep=("page_id",), html: str = "html") -> DataFrame:
    """One row per list link with its 1-based position (no shuffle)."""
    return explode_links(pages.select(*keep, link_array(html).alias("_links")), "_links", keep)
