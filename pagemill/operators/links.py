"""Jobs over links between pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions import urls
from pagemill.operators.exploding import number_items
from pagemill.operators.ordering import top_per_key


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Links of each page in document order, numbered from 1."""
    rest = [c for c in pages.columns if c != html]
    return number_items(pages, rest, H.hrefs(F.col(html)), "link_no", "href")


def resolve_links(links: DataFrame, href: str = "href", base: str = "url", into: str = "target") -> DataFrame:
    """Add the absolute form of each link."""
    return links.withColumn(into, urls.resolve(F.col(href), F.col(base)))


def link_class(src: Column, dst: Column, social: Sequence[str] = ()) -> Column:
    """``internal`` (same host), ``social``, ``external``, or ``other`` for an address without a host (mail, scripts)."""
    here, there = urls.host(src), urls.host(dst)
    kind = F.when(F.coalesce(there, F.lit("")) == "", F.lit("other")).when(here == there, F.lit("internal"))
    if social:
        kind = kind.when(urls.in_domain(there, social), F.lit("social"))
    return kind.otherwise(F.lit("external"))


def classify_links(
    edges: DataFrame,
    src: str = "src",
    dst: str = "dst",
    social: Sequence[str] = (),
    keep: Sequence[str] = ("internal", "external", "social", "other"),
) -> DataFrame:
    """Add the link class and keep the classes asked for."""
    classed = edges.withColumn("link_class", link_class(F.col(src), F.col(dst), social))
    return classed if len(set(keep)) == 4 else classed.filter(F.col("link_class").isin(list(keep)))


def frontier(links: DataFrame, fetched: DataFrame, link: str = "url", page: str = "url") -> DataFrame:
    """Distinct links found but not fetched.

    One grouping of both sides: it combines before its only shuffle, so a link
    on every page costs one row a task. (An anti join would be moved below the
    distinct by the optimizer and shuffle every single link.)
    """
    found = links.select(F.col(link).alias("url"), F.lit(False).alias("_fetched"))
    known = fetched.select(F.col(page).alias("url"), F.lit(True).alias("_fetched"))
    seen = found.unionByName(known).filter(F.col("url").isNotNull()).groupBy("url").agg(F.max("_fetched").alias("_fetched"))
    return seen.filter(~F.col("_fetched")).select("url")


def top_links(links: DataFrame, k: int = 3, page: str = "page_id", score: str = "score", url: str = "target") -> DataFrame:
    """The ``k`` best distinct links of each page; ties by URL."""
    return top_per_key(links.select(page, url, score).distinct(), [page], [F.desc(score), F.asc(url)], k)
