"""Inputs derived from the given tables: HTML, JSON and logs whose content is known.

The text is made from a table, so that what is extracted from it again can be
compared with the table itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.suite.registry import table

# Network events: the same SQL in both engines.
NET_SQL = """
SELECT event_id, user_id, ts,
       CASE event_type WHEN 'click' THEN 'request' WHEN 'signup' THEN 'request'
                       WHEN 'error' THEN 'request_failed' ELSE 'response' END AS event_type,
       concat('https://site', user_id % 7, '.example/p/', user_id) AS page_url,
       concat('https://site', user_id % 7, '.example/',
              CASE event_id % 4 WHEN 0 THEN 'api/' WHEN 1 THEN 'API/' ELSE 'img/' END, event_id) AS url,
       CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'xhr' WHEN 2 THEN 'image' WHEN 3 THEN 'script'
                         ELSE 'fetch' END AS resource_type,
       CASE event_id % 6 WHEN 0 THEN 'text/html; charset=utf-8' WHEN 2 THEN '' WHEN 5 THEN 'TEXT/HTML' END AS lower_type,
       CASE event_id % 6 WHEN 1 THEN 'application/json' WHEN 2 THEN 'text/html' END AS upper_type,
       CASE WHEN event_id % 4 = 0 THEN props END AS body,
       value
FROM events
"""

# Edges of the link graph: parts on consecutive lines of an order.
EDGE_SQL = """
SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
"""


def net_events(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(NET_SQL.replace("FROM events", "FROM {events}"), events=table(spark, sf, "events"))


def part_edges(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    sql = EDGE_SQL.replace("FROM lineitem a JOIN lineitem b", "FROM {lines} a JOIN {lines} b")
    return spark.sql(sql, lines=lines.select("l_orderkey", "l_linenumber", "l_partkey"))


def card(extra: str = "") -> str:
    """SQL for a product card of a part."""
    return f"""concat('<div class="card{extra}"><a href="//shop.example/p/', p_partkey, '" title="', p_name,
        '"></a><img src="//img.example/', p_partkey, '.jpg"><span class="price">', p_retailprice,
        '</span><span class="loc"> ', p_brand, ' </span></div>')"""


def card_pages(spark: SparkSession, sf: str, per_page: int = 20) -> DataFrame:
    """Catalogue pages of ``per_page`` cards; every third card has a second class."""
    cards = table(spark, sf, "part").select(
        F.floor(F.col("p_partkey") / per_page).alias("page_id"),
        "p_partkey",
        F.expr(f"CASE WHEN p_partkey % 3 = 0 THEN {card(' big')} ELSE {card()} END").alias("card"),
    )
    body = F.expr("listagg(card, '\n<hr>') WITHIN GROUP (ORDER BY p_partkey)")
    return cards.groupBy("page_id").agg(F.concat(F.lit('<html><body><div class="list">'), body, F.lit("</div>")).alias("html"))


def lazy_images(spark: SparkSession, sf: str) -> DataFrame:
    """One image a part, in the four forms an address comes in."""
    tag = """CASE p_partkey % 4
        WHEN 0 THEN concat('<img class="x" data-src="https://img.example/', p_partkey, '.jpg" src="data:image/gif;base64,R0lGODlh">')
        WHEN 1 THEN concat('<img alt="a" src="//img.example/', p_partkey, '.jpg">')
        WHEN 2 THEN concat('<IMG src="/img/', p_partkey, '.jpg" width="3">')
        ELSE concat('<img src="data:image/png;base64,', base64(cast(p_name AS binary)), '"/>') END"""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.expr("concat('https://shop.example/p/', p_partkey, '?q=1')").alias("url"),
        F.expr(f"concat('<p>', p_name, {tag}, '</p>')").alias("html"),
    )


def jsonld_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Product pages with JSON-LD: some without offers, some with a null description, some that do not parse."""
    data = """concat('{"image":"https://img.example/', p_partkey, '.jpg",',
        CASE WHEN p_partkey % 7 = 0 THEN '' ELSE concat('"offers":{"price":"Rs. ', p_retailprice, '"},') END,
        '"aggregateRating":{"ratingValue":', p_size, '},"description":',
        CASE WHEN p_partkey % 5 = 0 THEN 'null' ELSE concat('"', p_name, '"') END,
        CASE WHEN p_partkey % 11 = 0 THEN '' ELSE '}' END)"""
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("page_id"),
        F.expr(f"""concat('<html><head><title>', p_name, '</title><script type="application/ld+json">\n', {data},
            '\n</script><script>var x = {{}};</script></head></html>')""").alias("html"),
    )


def spec_pages(spark: SparkSession, sf: str, per_page: int = 8) -> DataFrame:
    """Specification tables: two header levels, a cell over all rows, blanks, a repeated header, nested tables."""
    part = table(spark, sf, "part").withColumn("page_id", F.floor(F.col("p_partkey") / per_page))
    row = """concat('<tr>', CASE WHEN p_partkey % 8 = 0 THEN concat('<td rowspan="8">Group ', page_id, '</td>') ELSE '' END,
        '<td><b>', p_name, '</b></td><td>', CASE WHEN p_partkey % 9 = 0 THEN ' ' ELSE cast(p_retailprice AS string) END,
        '</td><td>', p_brand, '</td><td>', p_type,
        CASE WHEN p_partkey % 16 = 3 THEN concat('<table><tr><th>Inner</th></tr><tr><td>', p_size, '</td></tr></table>') ELSE '' END,
        '</td></tr>')"""
    head = (
        '<nav><table><tr><td>skip</td></tr></table></nav><div class="l-adaptive-content x"><table border="1"><tbody>'
        '<tr><td class="headerCell" rowspan="2">Group</td><td class="headerCell" colspan="2">Item</td>'
        '<th rowspan="2">Brand</th><th rowspan="2">Brand</th></tr>'
        '<tr><td class="headerCell">Name</td><td class="headerCell">Price</td></tr>'
    )
    rows = F.expr("listagg(row, '\n') WITHIN GROUP (ORDER BY p_partkey)")
    return (
        part.withColumn("row", F.expr(row))
        .groupBy("page_id")
        .agg(F.concat(F.lit(head), rows, F.lit("</tbody></table></div>")).alias("html"))
    )


# Body cells of the outer and the nested tables of spec_pages, straight from the parts.
SPEC_CELLS_SQL = """
SELECT p_partkey // 8 AS page_id, p_partkey, p_partkey % 8 + 1 AS row_no, c.col_no,
       CASE c.col_no WHEN 1 THEN 'Group' WHEN 2 THEN 'Item Name' WHEN 3 THEN 'Item Price' WHEN 4 THEN 'Brand'
                     ELSE 'Brand_2' END AS header,
       CASE c.col_no WHEN 1 THEN concat('Group ', p_partkey // 8) WHEN 2 THEN p_name
                     WHEN 3 THEN CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_retailprice AS VARCHAR) END
                     WHEN 4 THEN p_brand
                     ELSE CASE WHEN p_partkey % 16 = 3 THEN concat(p_type, 'Inner ', p_size) ELSE p_type END END AS value
FROM part, (SELECT unnest([1, 2, 3, 4, 5]) AS col_no) c
"""


def product_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Model answers: arrays of ten products, every fifth cut off so that it does not parse."""
    item = """to_json(named_struct('url', concat('https://shop.example/p/', p_partkey), 'title', p_name,
        'price', concat('Rs. ', p_retailprice),
        'units_sold', CASE WHEN p_partkey % 4 = 0 THEN 'many' ELSE cast(p_size AS string) END,
        'rating', p_size / 10), map('ignoreNullFields', 'false'))"""
    part = table(spark, sf, "part").withColumn("batch_no", F.floor(F.col("p_partkey") / 10)).withColumn("item", F.expr(item))
    array = F.concat(F.lit("["), F.expr("listagg(item, ',') WITHIN GROUP (ORDER BY p_partkey)"))
    closed = F.when(F.col("batch_no") % 5 == 0, F.col("text")).otherwise(F.concat(F.col("text"), F.lit("]")))
    return part.groupBy("batch_no").agg(array.alias("text")).select("batch_no", closed.alias("response"))


VENUE_JSON = """concat('{"name":"', p_name, ' ', p_partkey % 50, '","location":"', p_brand, '","price":',
    CASE WHEN p_partkey % 8 = 0 THEN 'null' ELSE concat('"', p_retailprice, '"') END,
    CASE WHEN p_partkey % 6 = 0 THEN '' ELSE concat(',"capacity":"', p_size, '"') END,
    ',"rating":4.5,"reviews":', p_size, ',"description":"', p_type, '","error":false}')"""


def venue_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records as JSON: some lack a key, some have a null, some names come again."""
    return table(spark, sf, "part").select("p_partkey", F.expr(VENUE_JSON).alias("json"))


def capture_bundles(spark: SparkSession, sf: str, size: int = 200) -> DataFrame:
    """Network events packed into capture bundles, as JSON text."""
    from pagemill.sources.writers import bundle_captures

    request = F.expr("""to_json(named_struct('event_type', event_type, 'url', url, 'resource_type', resource_type,
        'timestamp', unix_micros(cast(ts AS timestamp)) / 1e6,
        'headers', named_struct('content-type', lower_type, 'Content-Type', upper_type),
        'body', parse_json(body)))""")
    message = F.expr("""to_json(named_struct('type', 'error', 'text', url))""")
    # A failed request shows up as a console message too here; both arrays then have content.
    events = net_events(spark, sf)
    bundles = bundle_captures(
        events, "page_url", "event_id", request, message, F.col("event_type") == "request_failed", size
    )
    return bundles.select(
        "url",
        "bundle_no",
        F.concat(
            F.lit('{"url":"'), "url", F.lit('","network_requests":['), F.array_join("network_requests", ","),
            F.lit('],"console_messages":['), F.array_join("console_messages", ","), F.lit("]}"),
        ).alias("json"),
    )
