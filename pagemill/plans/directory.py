"""Paged result lists to one table of complete, distinct records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import variants
from pagemill.operators import html, records
from pagemill.operators.exploding import number_items
from pagemill.operators.ordering import null_safe_join
from pagemill.sources.schemas import VENUE, VENUE_KEYS
from pagemill.storage import cut_lineage


def listed_records(
    pages: DataFrame,
    site: str,
    page_no: str,
    body: str = "html",
    response: str = "response",
    required: Sequence[str] = VENUE_KEYS,
    schema: T.StructType = VENUE,
    name: str = "name",
) -> DataFrame:
    """Records of each site up to the first page that adds none.

    A record counts if it has all required keys and is the first of its name
    on the site. A page without results, or whose records are all incomplete
    or known, ends the site. Which record is first does not depend on where
    the site ends, so the records are made distinct first and the end of each
    site is the least page without a first record.
    """
    flagged = html.flag_empty(pages, html=body)
    whole = F.filter(variants.items(F.col(response)), lambda item: variants.has_keys(F.to_json(item), required))
    items = number_items(flagged, [site, page_no], whole, "item_no", "item")
    first = records.first_per_key(records.to_typed(items, schema), [site, name], [page_no, "item_no"])
    first = cut_lineage(first, "first-records")  # used twice below, parsed once
    fresh = first.groupBy(site, page_no).agg(F.count("*").alias("_fresh"))
    marked = null_safe_join(flagged.select(site, page_no, "is_empty"), fresh, [site, page_no], "left")
    marked = cut_lineage(marked, "marked-pages")
    visited = records.until_stop(marked, site, page_no, F.col("is_empty") | F.col("_fresh").isNull())
    return null_safe_join(first, visited.select(site, page_no), [site, page_no], "left_semi")
