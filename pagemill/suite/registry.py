"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from pagemill.functions.text import WHITESPACE
from pagemill.session import ship_package
from pagemill.storage import spread_small

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The white-space set as a SQL expression.
SQL_BLANKS = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # the event log has no zone
            return function(spark, sf_dir)

        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql.replace("{blanks}", SQL_BLANKS)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A table whose rows are costly to read: a small single file is spread over the cores."""
    return spread_small(table(spark, sf_dir, name), key)
