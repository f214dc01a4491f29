"""Rows out of arrays that are costly to compute."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number_items(
    df: DataFrame, keep: Sequence[str], items: Column | str, number: str, item: str, start: int = 1
) -> DataFrame:
    """One row for each array element, numbered from ``start``; empty and null arrays give none.

    An inner explode makes the optimizer test the size of the array in a
    filter below it, which computes the array, here a parse of the whole text,
    again. The outer form has no such test; its rows without an element are
    dropped after it.
    """
    rows = df.select(*keep, F.posexplode_outer(items).alias(number, item)).filter(F.col(number).isNotNull())
    return rows.withColumn(number, (F.col(number) + start).cast("long"))
