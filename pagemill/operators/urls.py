"""Jobs over URL columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import urls
from pagemill.operators.ordering import first_per_key, lookup_join


def filter_urls(df: DataFrame, regex: str, url: str = "url") -> DataFrame:
    """Keep URLs that contain a match of ``regex``."""
    return df.filter(urls.matches_regex(regex)(F.col(url)))


def filter_globs(df: DataFrame, patterns: Sequence[str], url: str = "url") -> DataFrame:
    """Keep URLs that match any of the globs."""
    return df.filter(urls.matches_any_glob(patterns)(F.col(url)))


def filter_domains(
    df: DataFrame, allowed: Sequence[str] = (), blocked: Sequence[str] = (), url: str = "url"
) -> DataFrame:
    """Keep URLs of the allowed domains and their subdomains; a block wins."""
    return df.filter(urls.in_domains(allowed, blocked)(F.col(url)))


def filter_domain_table(df: DataFrame, blocked: DataFrame, url: str = "url", domain: str = "domain") -> DataFrame:
    """As a block list of :func:`filter_domains`, for a list kept as a table.

    The list is matched with the distinct hosts, not with the rows, and the
    verdict on each host is looked up by its rows.
    """
    named = df.withColumn("_host", urls.host(F.col(url)))
    hosts = named.groupBy("_host").agg(F.count("*").alias("_n"))
    suffixes = hosts.select("_host", F.explode(urls.host_suffixes(F.col("_host"))).alias(domain))
    hits = suffixes.join(blocked.select(F.lower(domain).alias(domain)), domain, "left_semi").select("_host").distinct()
    verdicts = hosts.join(hits.withColumn("_blocked", F.lit(True)), "_host", "left")
    return lookup_join(named, verdicts, "_host").filter(F.col("_blocked").isNull()).select(*df.columns)


def filter_content_type(df: DataFrame, types: Sequence[str], column: str = "content_type") -> DataFrame:
    """Keep rows of the media types."""
    return df.filter(urls.is_content_type(types)(F.col(column)))


def filter_chain(df: DataFrame, predicates: Sequence[urls.Predicate], mode: str = "and", url: str = "url") -> DataFrame:
    """Apply a chain of URL filters as one predicate."""
    return df.filter(urls.combine(predicates, mode)(F.col(url)))


def normalize_urls(df: DataFrame, url: str = "url", into: str = "canonical_url", **options) -> DataFrame:
    """Add the comparison form of the URL; options as for :func:`urls.canonical`."""
    return df.withColumn(into, urls.canonical(F.col(url), **options))


def dedupe_urls(df: DataFrame, seq: str | Sequence[str], url: str = "url", **options) -> DataFrame:
    """The first original URL of every canonical URL, by one or more columns ``seq``."""
    order = [seq] if isinstance(seq, str) else list(seq)
    return first_per_key(normalize_urls(df, url, "canonical_url", **options), ["canonical_url"], order)


def pick_links(df: DataFrame, regex: str = urls.PRODUCT_LINK, n: int = 10, url: str = "url") -> DataFrame:
    """The first ``n`` distinct matching links in URL order."""
    return filter_urls(df, regex, url).select(url).distinct().orderBy(url).limit(n)


def page_urls(df: DataFrame, n: int, base: str = "base_url") -> DataFrame:
    """Numbered result pages ``?page=1`` to ``n`` of each base URL."""
    numbered = df.withColumn("page_no", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))))
    return numbered.withColumn("url", F.concat(F.col(base), F.lit("?page="), F.col("page_no")))


def score_urls(df: DataFrame, keywords: Sequence[str], weight: float = 1.0, url: str = "url") -> DataFrame:
    """Add the keyword score of the URL."""
    return df.withColumn("score", urls.keyword_score(F.col(url), keywords, weight))


def score_filter(df: DataFrame, least: float, score: str = "score") -> DataFrame:
    """Keep links, images or tables that score at least ``least``; a missing score is 0."""
    return df.filter(F.coalesce(F.col(score), F.lit(0.0)) >= least)
