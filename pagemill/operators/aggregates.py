"""Counts and samples over network, console and page tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pagemill.operators.ordering import top_per_key

# Event types of a capture, and how much of a message is shown.
REQUEST, RESPONSE, FAILED = "request", "response", "request_failed"
MESSAGE_CHARS = 100


def event_counts(events: DataFrame, by: Sequence[str] = (), event_type: str = "event_type") -> DataFrame:
    """Requests, responses and failed requests in one pass."""
    kind = F.col(event_type)
    return events.groupBy(*by).agg(
        F.count_if(kind == REQUEST).alias("requests"),
        F.count_if(kind == RESPONSE).alias("responses"),
        F.count_if(kind == FAILED).alias("failed"),
    )


def api_calls(events: DataFrame, needle: str = "api", ignore_case: bool = False) -> DataFrame:
    """Requests whose URL contains ``needle``; a missing URL does not."""
    url = F.lower("url") if ignore_case else F.col("url")
    wanted = needle.lower() if ignore_case else needle
    return events.filter((F.col("event_type") == REQUEST) & url.contains(wanted))


def first_with_total(df: DataFrame, order: Sequence[str | Column], n: int, total: str = "total") -> DataFrame:
    """The first ``n`` rows in order, with the number of all rows."""
    count = df.agg(F.count("*").alias(total))
    return df.orderBy(*order).limit(n).withColumn(total, count.scalar())


def histogram(df: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """Rows of each value. Missing values count as ``missing``, or not at all if that is None."""
    value = F.col(column) if missing is None else F.coalesce(F.col(column), F.lit(missing))
    kept = df.filter(F.col(column).isNotNull()) if missing is None else df
    return kept.groupBy(value.alias(column)).agg(F.count("*").alias("n"))


def resource_histogram(events: DataFrame) -> DataFrame:
    return histogram(events, "resource_type")


def message_histogram(messages: DataFrame, column: str = "type") -> DataFrame:
    return histogram(messages, column, "unknown")


def pages_by_depth(results: DataFrame) -> DataFrame:
    """Pages of each depth; a missing depth is 0."""
    depth = F.coalesce(F.col("depth"), F.lit(0)).cast("long")
    return results.groupBy(depth.alias("depth")).agg(F.count("*").alias("pages")).orderBy("depth")


def mean_score(results: DataFrame, score: str = "score") -> DataFrame:
    """Pages and mean score, a missing score as 0; no row when there are no pages."""
    value = F.coalesce(F.col(score), F.lit(0.0))
    return results.agg(F.count("*").alias("pages"), F.avg(value).alias("mean_score")).filter(F.col("pages") > 0)


def observe_stage(df: DataFrame, stage: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Count the rows that pass a stage while the job runs; no job of its own."""
    observation = Observation(stage)
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in metrics.items()]), observation


def run_stages(df: DataFrame, stages: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]], write: Callable[[DataFrame], None]) -> DataFrame:
    """Write what the stages leave of ``df``; ``stage, n`` of the rows that left each of them, without a job of its own.

    Every stage is a name and a function of the frame before it. The counts are
    taken by the job that writes. If an executor is lost the tasks it had done
    are run again and may be counted again; :func:`stage_counts` is exact then too.
    """
    observed = []
    for name, stage in stages:
        df, observation = observe_stage(stage(df), name)
        observed.append((name, observation))
    write(df)
    return df.sparkSession.createDataFrame([(name, o.get["rows"]) for name, o in observed], "stage string, n long")


def stage_counts(df: DataFrame, found: Column, key: Column) -> DataFrame:
    """Rows read, found and unique among the found, in one pass."""
    counts = df.agg(
        F.count("*").alias("read"),
        F.count_if(found).alias("found"),
        F.count_distinct(F.when(found, key)).alias("unique"),
    )
    stages = F.explode(F.create_map(*[x for n in ("read", "found", "unique") for x in (F.lit(n), F.col(n))]))
    return counts.select(stages.alias("stage", "n"))


def first_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows in order, without a full sort."""
    return df.orderBy(*order).limit(n)


def error_samples(
    messages: DataFrame, key: str, order: Sequence[str], n: int = 3, kind: str = "type", text: str = "text"
) -> DataFrame:
    """The first error messages of each page, cut short; a missing text is empty."""
    errors = messages.filter(F.col(kind) == "error")
    slim = errors.select(key, *order, F.substring(F.coalesce(F.col(text), F.lit("")), 1, MESSAGE_CHARS).alias("message"))
    return top_per_key(slim, [key], order, n)
