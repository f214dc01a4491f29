"""Idle detection over an event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IDLE_MS = 4_000  # fixed value: a page is quiet after more than this without activity
SPAN_SLOTS = 100_000  # slots of the gap's length that one window orders


def idle_sessions(events: DataFrame, key: str, ts: str = "ts", gap_ms: int = IDLE_MS, span_slots: int = SPAN_SLOTS) -> DataFrame:
    """Bursts of activity of each key, and the moment it went idle.

    A gap of exactly ``gap_ms`` continues the session. Events in one slot of
    that length are always in one session, so each slot is first folded to
    its first and last moment and count, which combines before the shuffle.
    The slots of a key are ordered by windows over spans of ``span_slots``
    slots. A span's last session goes on in the next span if that begins
    within the gap, which the spans' first and last moments tell: a row a
    span. So a busy key, or one with a very small gap, is worked on in as many
    tasks as it has spans. Null keys are a key; events without a time are left out.
    """
    gap = gap_ms * 1000
    moment = F.unix_micros(F.col(ts).cast("timestamp"))
    slots = (
        events.filter(F.col(ts).isNotNull())
        .select(key, moment.alias("_at"))
        .groupBy(key, F.floor(F.col("_at") / F.lit(gap)).alias("_slot"))
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count("*").alias("_n"))
    )
    # One struct as the key of windows, groups and join: a single shuffle serves them, and null keys meet.
    spans = slots.withColumn("_span", F.struct(F.col(key).alias("key"), F.floor(F.col("_slot") / F.lit(span_slots)).alias("no")))
    by_time = Window.partitionBy("_span").orderBy("_first")
    quiet = F.col("_first") - F.lag("_last").over(by_time)
    opened = spans.withColumn("_opens", F.coalesce((quiet > gap).cast("long"), F.lit(1)))
    numbered = opened.withColumn("_no", F.sum("_opens").over(by_time.rowsBetween(Window.unboundedPreceding, 0)))
    parts = numbered.groupBy("_span", "_no").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
    ends = parts.groupBy("_span").agg(F.min("_first").alias("_begin"), F.max("_last").alias("_end"), F.max("_no").alias("_own"))
    by_span = Window.partitionBy(F.col("_span")["key"]).orderBy(F.col("_span")["no"])
    goes_on = F.coalesce((F.col("_begin") - F.lag("_end").over(by_span) <= gap).cast("long"), F.lit(0))
    linked = ends.withColumn("_goes_on", goes_on)
    earlier = F.sum(F.col("_own") - F.col("_goes_on")).over(by_span.rowsBetween(Window.unboundedPreceding, -1))
    before = linked.select("_span", (F.coalesce(earlier, F.lit(0)) - F.col("_goes_on")).alias("_before"))
    placed = parts.join(before, "_span").select(F.col("_span")["key"].alias(key), (F.col("_before") + F.col("_no")).alias("session_no"), "_first", "_last", "_n")
    return placed.groupBy(key, "session_no").agg(
        F.timestamp_micros(F.min("_first")).alias("session_start"),
        F.timestamp_micros(F.max("_last")).alias("session_end"),
        F.timestamp_micros(F.max("_last") + gap).alias("idle_at"),
        F.sum("_n").alias("n_events"),
    )
