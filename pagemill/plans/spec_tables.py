"""Product pages to specification tables in long form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pagemill.operators import batches, html


def spec_cells(pages: DataFrame, container: str = ".l-adaptive-content") -> DataFrame:
    """Cells of every table below the container, keyed by page and position on it."""
    return html.table_cells(pages, container)


def table_batches(tables: DataFrame, group: Sequence[str], order: str, limit: int = batches.TOKEN_LIMIT) -> DataFrame:
    """Token-bounded batches of raw tables, for those who want model batches still."""
    return batches.pack_batches(batches.with_tokens(tables, "html"), group, order, limit)
