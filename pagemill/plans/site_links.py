"""Pages to a link profile of every host."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import urls
from pagemill.operators import links as L


def page_edges(pages: DataFrame) -> DataFrame:
    """``(page_id, src, dst)`` of every link with its absolute target."""
    found = L.resolve_links(L.extract_links(pages))
    return found.select("page_id", "link_no", F.col("url").alias("src"), F.col("target").alias("dst"))


def link_profile(pages: DataFrame, social: Sequence[str] = ()) -> DataFrame:
    """Pages, links and link classes of each host."""
    edges = L.classify_links(page_edges(pages), social=social)
    return edges.groupBy(urls.host(F.col("src")).alias("host")).agg(
        F.count("*").alias("links"),
        F.count_if(F.col("link_class") == "internal").alias("internal"),
        F.count_if(F.col("link_class") == "external").alias("external"),
        F.count_if(F.col("link_class") == "social").alias("social"),
    )
