"""Captured network logs to counts, samples and response bodies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import variants
from pagemill.operators import aggregates, records
from pagemill.sources.readers import flatten_captures


def typed_events(captures: DataFrame, json: str, *keys: str) -> DataFrame:
    """Flat events with the columns the counts need."""
    events = flatten_captures(captures, json, *keys)
    item = F.col("event")
    return events.select(
        *keys,
        "page_url",
        "event_no",
        variants.get(item, "$.event_type").alias("event_type"),
        variants.get(item, "$.url").alias("url"),
        variants.get(item, "$.method").alias("method"),
        variants.get(item, "$.resource_type").alias("resource_type"),
        "event",
    )


def capture_summary(events: DataFrame) -> DataFrame:
    """Counts of each captured page in one pass, API requests included."""
    is_api = (F.col("event_type") == aggregates.REQUEST) & F.lower("url").contains("api")
    kind = F.col("event_type")
    return events.groupBy("page_url").agg(
        F.count("*").alias("events"),
        F.count_if(kind == aggregates.REQUEST).alias("requests"),
        F.count_if(kind == aggregates.RESPONSE).alias("responses"),
        F.count_if(kind == aggregates.FAILED).alias("failed"),
        F.count_if(is_api).alias("api_calls"),
    )


def saved_responses(events: DataFrame) -> DataFrame:
    return records.response_events(events)
