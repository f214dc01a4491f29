"""Record queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import variants
from pagemill.operators import records as R
from pagemill.plans import catalogue, directory, network_log
from pagemill.suite import fixtures as X
from pagemill.suite.registry import query, table

COMPLETE_SQL = """SELECT p_partkey, p_name || ' ' || p_partkey % 50 AS name,
    CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE CAST(p_retailprice AS VARCHAR) END AS price, CAST(p_size AS BIGINT) AS reviews
    FROM part WHERE p_partkey % 6 <> 0"""


def venues(spark, sf):
    return R.complete(X.venue_records(spark, sf)).select(
        "p_partkey",
        variants.get(variants.parse(F.col("json")), "$.name").alias("name"),
        variants.get(variants.parse(F.col("json")), "$.price").alias("price"),
        variants.get(variants.parse(F.col("json")), "$.reviews", "long").alias("reviews"),
    )


@query(COMPLETE_SQL)
def complete_records(spark, sf):
    return venues(spark, sf)


@query(
    f"""SELECT p_partkey, name, price, reviews FROM (
      SELECT *, row_number() OVER (PARTITION BY name ORDER BY p_partkey) AS rn FROM ({COMPLETE_SQL})) WHERE rn = 1"""
)
def complete_distinct(spark, sf):
    """Complete first, then distinct: an incomplete record never claims a name."""
    return R.dedupe_records(venues(spark, sf), "name", ["p_partkey"])


@query(
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1"""
)
def dedupe_records(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return R.dedupe_records(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 1 THEN 'true' WHEN 3 THEN '"false"' WHEN 4 THEN '0' END AS error,
    concat('{', CASE o_orderkey % 5 WHEN 1 THEN '"error":true,' WHEN 3 THEN '"error":"false",' WHEN 4 THEN '"error":0,' ELSE '' END,
      '"id":', o_orderkey, ',"status":"', o_orderstatus, '"}') AS json FROM orders"""
)
def drop_false_error(spark, sf):
    json = F.expr("""concat('{', CASE o_orderkey % 5 WHEN 0 THEN '"error":false,' WHEN 1 THEN '"error":true,'
        WHEN 3 THEN '"error":"false",' WHEN 4 THEN '"error":0,' ELSE '' END, '"id":', o_orderkey, ',"status":"', o_orderstatus, '"}')""")
    return R.drop_false_error(table(spark, sf, "orders").select("o_orderkey", json.alias("json")))


@query(
    """SELECT p_partkey // 10 AS page_id, p_partkey % 10 AS block_no,
      CASE WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 4 = 0 THEN p_name ELSE upper(p_name) END AS title,
      CASE WHEN p_partkey % 3 = 0 THEN p_brand WHEN p_partkey % 5 = 0 THEN p_brand ELSE '0' END AS location,
      CASE WHEN p_partkey % 3 = 0 OR p_partkey % 2 = 0 THEN p_size ELSE p_size + 1 END AS units_sold,
      CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN NULL ELSE p_retailprice END AS rating FROM part"""
)
def merge_records(spark, sf):
    """Answers for two thirds of the blocks, with empty, zero and null fields among them."""
    key = F.col("p_partkey")
    keys = [F.floor(key / 10).alias("page_id"), (key % 10).alias("block_no")]
    part = table(spark, sf, "part")
    parsed = part.select(
        *keys, F.col("p_name").alias("title"), F.col("p_brand").alias("location"), F.col("p_size").alias("units_sold"),
        F.lit(None).cast("double").alias("rating"),
    )
    model = part.filter(key % 3 != 0).select(
        *keys,
        F.when(key % 4 == 0, F.lit("")).otherwise(F.upper("p_name")).alias("title"),
        F.when(key % 5 == 0, F.lit(None)).otherwise(F.lit("0")).alias("location"),
        F.when(key % 2 == 0, F.lit(0)).otherwise(F.col("p_size") + 1).alias("units_sold"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("p_retailprice")).alias("rating"),
    )
    return R.merge_records(parsed, model, ["page_id", "block_no"])


ANSWERS = """FROM part WHERE (p_partkey // 10) % 5 <> 0"""


@query(f"SELECT p_partkey // 10 AS batch_no, p_partkey % 10 + 1 AS item_no, p_name AS title {ANSWERS}")
def explode_response(spark, sf):
    items = R.explode_response(X.product_responses(spark, sf))
    return items.select("batch_no", "item_no", variants.get(F.col("item"), "$.title").alias("title"))


@query(
    f"""SELECT p_partkey // 10 AS batch_no, p_partkey % 10 + 1 AS item_no, 'https://shop.example/p/' || p_partkey AS url,
    CAST(NULL AS VARCHAR) AS photo, p_name AS title, 'Rs. ' || CAST(p_retailprice AS VARCHAR) AS price,
    CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS units_sold, CAST(p_size / 10 AS DOUBLE) AS rating,
    CAST(NULL AS VARCHAR) AS location {ANSWERS}"""
)
def to_product(spark, sf):
    good, _ = catalogue.answered_products(X.product_responses(spark, sf))
    return good


@query(
    """SELECT doc_id, json_valid(response) AS is_valid, CASE WHEN json_valid(response) THEN NULL ELSE length(response) END AS raw_length FROM (
      SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN concat('{"id":', doc_id, ',"x":[1,null]}') WHEN 1 THEN text
        ELSE concat('[{"id":', doc_id, '}') END AS response FROM documents)"""
)
def split_responses(spark, sf):
    response = F.expr("""CASE doc_id % 3 WHEN 0 THEN concat('{"id":', doc_id, ',"x":[1,null]}') WHEN 1 THEN text
        ELSE concat('[{"id":', doc_id, '}') END""")
    good, bad = R.split_responses(table(spark, sf, "documents").select("doc_id", response.alias("response")))
    kept = good.select("doc_id", F.lit(True).alias("is_valid"), F.lit(None).cast("long").alias("raw_length"))
    return kept.unionByName(bad.select("doc_id", F.lit(False).alias("is_valid"), F.length("raw").cast("long").alias("raw_length")))


@query(
    """SELECT event_type <> 'error' AS success, event_type AS status, count(*) AS n,
      CASE WHEN event_type = 'error' THEN min(props) END AS message FROM events GROUP BY event_type"""
)
def split_results(spark, sf):
    good, bad = R.split_results(table(spark, sf, "events"), F.col("event_type") != "error")
    done = good.groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"))
    failed = bad.groupBy(F.col("event_type").alias("status")).agg(F.count("*").alias("n"), F.min("props").alias("message"))
    return done.select(F.lit(True).alias("success"), "status", "n", F.lit(None).cast("string").alias("message")).unionByName(
        failed.select(F.lit(False).alias("success"), "status", "n", "message")
    )


@query(
    """SELECT user_id, event_id, event_type FROM (SELECT *, max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
      OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS stopped FROM events) WHERE stopped = 0"""
)
def until_stop(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return R.until_stop(events, "user_id", "event_id", F.col("event_type") == "error")


@query(
    f"""SELECT page_url, url, round(epoch(ts) * 1000)::BIGINT AS ms, json_extract_string(body, '$.k') AS k,
      coalesce(nullif(lower_type, ''), upper_type) AS content_type FROM ({X.NET_SQL})
    WHERE event_type = 'response' AND (body IS NOT NULL OR coalesce(nullif(lower_type, ''), upper_type) IS NOT NULL)"""
)
def response_events(spark, sf):
    events = network_log.typed_events(X.capture_bundles(spark, sf), "json").select("page_url", "event")
    return network_log.saved_responses(events).select(
        "page_url",
        "url",
        F.round(F.col("timestamp") * 1000).cast("long").alias("ms"),
        variants.get(F.col("body"), "$.k").alias("k"),
        "content_type",
    )


@query(
    """WITH p AS (SELECT *, p_partkey % 40 AS site, p_partkey // 40 AS page_no, (p_partkey // 40) % 9 = 8 AS is_empty FROM part),
    r AS (SELECT site, page_no, 0 AS item, p_name AS name, p_size AS reviews FROM p WHERE p_partkey % 6 <> 0
          UNION ALL SELECT site, page_no, 1, p_brand, p_size + 1 FROM p WHERE (p_partkey + 1) % 6 <> 0),
    d AS (SELECT *, row_number() OVER (PARTITION BY site, name ORDER BY page_no, item) AS rn FROM r),
    f AS (SELECT * FROM d WHERE rn = 1),
    s AS (SELECT site, min(page_no) AS stop FROM p
          WHERE is_empty OR (site, page_no) NOT IN (SELECT (site, page_no) FROM f) GROUP BY site)
    SELECT f.site, page_no, name, CAST(reviews AS BIGINT) AS reviews FROM f LEFT JOIN s ON f.site = s.site WHERE s.stop IS NULL OR page_no < s.stop"""
)
def listed_records(spark, sf):
    """Result pages of forty sites, two records a page, up to the first page that adds none."""
    key = F.col("p_partkey")
    def item(name: str, lacks: str, reviews: str) -> str:
        return f"""concat('{{"name":"', {name}, '"', CASE WHEN {lacks} THEN '' ELSE ',"location":null' END, ',"reviews":', {reviews}, '}}')"""

    first = item("p_name", "p_partkey % 6 = 0", "p_size")
    second = item("p_brand", "(p_partkey + 1) % 6 = 0", "p_size + 1")
    pages = table(spark, sf, "part").select(
        (key % 40).alias("site"),
        F.floor(key / 40).alias("page_no"),
        F.when(F.floor(key / 40) % 9 == 8, F.lit("<p>No Results Found</p>")).otherwise(F.lit("<p>ok</p>")).alias("html"),
        F.expr(f"concat('[', {first}, ',', {second}, ']')").alias("response"),
    )
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("reviews", T.LongType())])
    found = directory.listed_records(
        pages, "site", "page_no", required=["name", "location", "reviews"], schema=schema
    )
    return found.select("site", "page_no", "name", "reviews")
