"""Counts, samples and sessions."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.operators import aggregates as A
from pagemill.operators.ordering import first_per_key
from pagemill.operators.sessions import idle_sessions as sessions
from pagemill.plans import network_log
from pagemill.storage import scratch_path
from pagemill.suite import fixtures as X
from pagemill.suite.registry import query, table

SESSIONS_SQL = """WITH e AS (SELECT {key} AS k, epoch_us(ts) AS us FROM events),
    l AS (SELECT k, us, CASE WHEN us - lag(us) OVER (PARTITION BY k ORDER BY us) <= {gap} THEN 0 ELSE 1 END AS opens FROM e),
    s AS (SELECT k, us, sum(opens) OVER (PARTITION BY k ORDER BY us RANGE UNBOUNDED PRECEDING) AS session_no FROM l)"""


@query(
    f"""SELECT page_url, count(*) FILTER (event_type = 'request') AS requests, count(*) FILTER (event_type = 'response') AS responses,
    count(*) FILTER (event_type = 'request_failed') AS failed FROM ({X.NET_SQL}) GROUP BY page_url"""
)
def event_counts(spark, sf):
    return A.event_counts(X.net_events(spark, sf), ["page_url"])


@query(
    f"""SELECT event_id, url, (SELECT count(*) FROM ({X.NET_SQL}) WHERE event_type = 'request' AND contains(url, 'api')) AS total
    FROM ({X.NET_SQL}) WHERE event_type = 'request' AND contains(url, 'api') ORDER BY event_id LIMIT 3"""
)
def api_calls(spark, sf):
    calls = A.api_calls(X.net_events(spark, sf)).select("event_id", "url")
    return A.first_with_total(calls, ["event_id"], 3)


@query(
    f"""SELECT event_id, url, (SELECT count(*) FROM ({X.NET_SQL}) WHERE event_type = 'request' AND contains(lower(url), 'api')) AS total
    FROM ({X.NET_SQL}) WHERE event_type = 'request' AND contains(lower(url), 'api') ORDER BY event_id LIMIT 5"""
)
def api_calls_any_case(spark, sf):
    calls = A.api_calls(X.net_events(spark, sf), ignore_case=True).select("event_id", "url")
    return A.first_with_total(calls, ["event_id"], 5)


@query(f"SELECT resource_type, count(*) AS n FROM ({X.NET_SQL}) WHERE resource_type IS NOT NULL GROUP BY resource_type")
def resource_histogram(spark, sf):
    return A.resource_histogram(X.net_events(spark, sf))


@query("SELECT coalesce(nullif(event_type, 'signup'), 'unknown') AS type, count(*) AS n FROM events GROUP BY 1")
def message_histogram(spark, sf):
    messages = table(spark, sf, "events").select(F.nullif(F.col("event_type"), F.lit("signup")).alias("type"))
    return A.message_histogram(messages)


@query(
    f"""SELECT page_url, count(*) AS events, count(*) FILTER (event_type = 'request') AS requests,
    count(*) FILTER (event_type = 'response') AS responses, CAST(0 AS BIGINT) AS failed,
    count(*) FILTER (event_type = 'request' AND contains(lower(url), 'api')) AS api_calls
    FROM ({X.NET_SQL}) WHERE event_type <> 'request_failed' GROUP BY page_url"""
)
def capture_summary(spark, sf):
    """From bundle text; the failed requests of the fixture are console messages."""
    return network_log.capture_summary(network_log.typed_events(X.capture_bundles(spark, sf), "json"))


@query(
    """SELECT 'read' AS stage, count(*) AS n FROM pages
    UNION ALL SELECT 'found', count(*) FROM pages WHERE contains(url, '/en/')
    UNION ALL SELECT 'unique', count(DISTINCT regexp_extract(url, '^[a-z]+://([^/]*)', 1)) FROM pages WHERE contains(url, '/en/')"""
)
def stage_counts(spark, sf):
    host = F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1)
    return A.stage_counts(table(spark, sf, "pages").select("url"), F.col("url").contains("/en/"), host)


@query(
    """SELECT 'read' AS stage, count(*) AS n FROM pages
    UNION ALL SELECT 'found', count(*) FROM pages WHERE contains(url, '/en/')
    UNION ALL SELECT 'unique', count(DISTINCT regexp_extract(url, '^[a-z]+://([^/]*)', 1)) FROM pages WHERE contains(url, '/en/')"""
)
def observed_stages(spark, sf):
    """The same counts, taken while the first page of each host is written."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1)
    path = scratch_path(spark, "first-pages")
    stages = [
        ("read", lambda df: df),
        ("found", lambda df: df.filter(F.col("url").contains("/en/"))),
        ("unique", lambda df: first_per_key(df.withColumn("host", host), ["host"], ["page_id"])),
    ]
    return A.run_stages(table(spark, sf, "pages").select("page_id", "url"), stages, lambda df: df.write.parquet(path))


@query("SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 10")
def first_n(spark, sf):
    return A.first_n(table(spark, sf, "pages").select("page_id", "url"), ["url", "page_id"], 10)


@query(
    """SELECT user_id, event_id, message, rank FROM (
      SELECT user_id, event_id, substr(coalesce(text, ''), 1, 100) AS message,
        row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rank FROM (
        SELECT user_id, event_id, CASE WHEN event_id % 10 = 0 THEN NULL ELSE concat(repeat('x', event_id % 150), props) END AS text
        FROM events WHERE event_type = 'error')) WHERE rank <= 3"""
)
def error_samples(spark, sf):
    text = F.expr("CASE WHEN event_id % 10 = 0 THEN NULL ELSE concat(repeat('x', cast(event_id % 150 AS int)), props) END")
    messages = table(spark, sf, "events").select("user_id", "event_id", F.col("event_type").alias("type"), text.alias("text"))
    return A.error_samples(messages, "user_id", ["event_id"], 3)


def micros(df, *columns):
    return df.withColumns({c: F.unix_micros(c) for c in columns})


@query(
    SESSIONS_SQL.format(key="user_id", gap=30 * 60 * 1_000_000)
    + """ SELECT k AS user_id, CAST(session_no AS BIGINT) AS session_no, min(us) AS session_start, max(us) AS session_end,
    max(us) + 1800000000 AS idle_at, count(*) AS n_events FROM s GROUP BY k, session_no"""
)
def idle_sessions(spark, sf):
    found = sessions(table(spark, sf, "events").select("user_id", "ts"), "user_id", gap_ms=30 * 60 * 1000)
    return micros(found, "session_start", "session_end", "idle_at")


@query(
    SESSIONS_SQL.format(key="event_type", gap=7 * 60 * 1_000_000)
    + """ SELECT k AS event_type, CAST(session_no AS BIGINT) AS session_no, min(us) AS session_start, max(us) AS session_end,
    max(us) + 420000000 AS idle_at, count(*) AS n_events FROM s GROUP BY k, session_no"""
)
def idle_sessions_by_type(spark, sf):
    """Few, busy keys: each holds a fifth of all events."""
    found = sessions(table(spark, sf, "events").select("event_type", "ts"), "event_type", gap_ms=7 * 60 * 1000)
    return micros(found, "session_start", "session_end", "idle_at")
