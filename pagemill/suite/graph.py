"""Link graph queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.operators import aggregates as A
from pagemill.operators import graph as G
from pagemill.plans import saved_crawl, site_links
from pagemill.storage import cut_lineage
from pagemill.suite.fixtures import EDGE_SQL, part_edges
from pagemill.suite.registry import query, table
from pagemill.suite.urls import LINKS

BFS_SQL = f"""WITH RECURSIVE e AS ({EDGE_SQL}),
    r AS (SELECT CAST(1 AS BIGINT) AS node, 0 AS depth UNION SELECT e.dst, r.depth + 1 FROM r JOIN e ON e.src = r.node WHERE r.depth < 3),
    b AS (SELECT node, CAST(min(depth) AS BIGINT) AS depth FROM r GROUP BY node)"""


def seed(spark, sf):
    return table(spark, sf, "part").filter("p_partkey = 1").select(F.col("p_partkey").alias("node"))


def edges(spark, sf):
    return cut_lineage(part_edges(spark, sf), "edges")


def reach(spark, sf):
    return G.bfs(edges(spark, sf), seed(spark, sf), 3)


@query(f"{BFS_SQL} SELECT node, depth FROM b")
def bfs_depth(spark, sf):
    return reach(spark, sf)


@query(f"{BFS_SQL} SELECT node, depth FROM b ORDER BY depth, node LIMIT 100")
def bfs_capped(spark, sf):
    return G.bfs(edges(spark, sf), seed(spark, sf), 3, max_pages=100)


@query(f"{BFS_SQL} SELECT depth, count(*) AS pages FROM b GROUP BY depth")
def pages_by_depth(spark, sf):
    return A.pages_by_depth(reach(spark, sf))


def beam_sql(depth: int, beam: int, least: float) -> str:
    steps = [
        f"e AS ({EDGE_SQL})",
        "l0 AS (SELECT p_partkey AS node, 0 AS depth, p_retailprice AS score FROM part WHERE p_partkey = 1)",
    ]
    for d in range(1, depth + 1):
        seen = " UNION ALL ".join(f"SELECT node FROM l{i}" for i in range(d))
        steps.append(
            f"""l{d} AS (SELECT node, {d} AS depth, score FROM (
              SELECT DISTINCT e.dst AS node, p_retailprice AS score FROM e JOIN l{d - 1} ON e.src = l{d - 1}.node
              JOIN part ON p_partkey = e.dst WHERE e.dst NOT IN ({seen}) AND p_retailprice >= {least})
            ORDER BY score DESC, node LIMIT {beam})"""
        )
    return "WITH " + ", ".join(steps) + " " + " UNION ALL ".join(f"SELECT node, CAST(depth AS BIGINT) AS depth, score FROM l{d}" for d in range(depth + 1))


@query(beam_sql(4, 20, 950.0))
def best_first(spark, sf):
    scores = table(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.col("p_retailprice").alias("score"))
    return G.best_first(edges(spark, sf), seed(spark, sf), scores, 20, 4, threshold=950.0)


@query(
    f"""WITH {LINKS}, p AS (SELECT DISTINCT page_id, url FROM links),
    n AS (SELECT a.url AS src, b.url AS dst FROM p a JOIN p b ON b.page_id IN (a.page_id + 1, a.page_id * 2)),
    e AS (SELECT DISTINCT src, dst FROM n WHERE src <> dst),
    s AS (SELECT url, 0.8 * (contains(lower(url), 'en')::INT + contains(lower(url), 'blog')::INT + contains(lower(url), 'html')::INT) / 3.0 AS score FROM p),
    l0 AS (SELECT url, 0.0 AS score, 0 AS depth FROM p WHERE page_id = 1),
    l1 AS (SELECT * FROM (SELECT DISTINCT s.url, s.score, 1 AS depth FROM e JOIN l0 ON e.src = l0.url JOIN s ON s.url = e.dst
           WHERE s.url NOT IN (SELECT url FROM l0)) ORDER BY score DESC, url LIMIT 3),
    l2 AS (SELECT * FROM (SELECT DISTINCT s.url, s.score, 2 AS depth FROM e JOIN l1 ON e.src = l1.url JOIN s ON s.url = e.dst
           WHERE s.url NOT IN (SELECT url FROM l0 UNION ALL SELECT url FROM l1)) ORDER BY score DESC, url LIMIT 3),
    l3 AS (SELECT * FROM (SELECT DISTINCT s.url, s.score, 3 AS depth FROM e JOIN l2 ON e.src = l2.url JOIN s ON s.url = e.dst
           WHERE s.url NOT IN (SELECT url FROM l0 UNION ALL SELECT url FROM l1 UNION ALL SELECT url FROM l2)) ORDER BY score DESC, url LIMIT 3)
    SELECT url, round(CAST(score AS DOUBLE), 9) AS score, depth FROM
      (SELECT * FROM l0 UNION ALL SELECT * FROM l1 UNION ALL SELECT * FROM l2 UNION ALL SELECT * FROM l3)"""
)
def scored_reach(spark, sf):
    """Pages linked to the next page and to the page of twice their number."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    steps = pages.select(F.col("url").alias("src"), F.explode(F.array(F.col("page_id") + 1, F.col("page_id") * 2)).alias("page_id"))
    linked = steps.join(pages.withColumnRenamed("url", "dst"), "page_id").select("src", "dst").filter("src <> dst").distinct()
    start = pages.filter("page_id = 1").select(F.col("url").alias("node"))
    found = saved_crawl.scored_reach(cut_lineage(linked, "links"), start, ["en", "blog", "html"], 0.8, 3, 3)
    return found.withColumn("score", F.round("score", 9))


@query(
    """WITH b AS (SELECT 0 AS run, page_id, url FROM pages WHERE page_id % 3 <> 0 UNION ALL SELECT 1, page_id, url FROM pages WHERE page_id % 3 <> 1),
    c AS (SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '\\?[^#]*', '') AS canonical_url FROM b)
    SELECT run, page_id, canonical_url FROM (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY run, page_id) AS rn FROM c) WHERE rn = 1"""
)
def merge_crawls(spark, sf):
    """Two runs over the pages that share a third of them."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    old, new = pages.filter("page_id % 3 <> 0"), pages.filter("page_id % 3 <> 1")
    merged = G.merge_crawls(old, new, ["page_id"], drop_query=True, drop_fragment=True)
    return merged.select("run", "page_id", "canonical_url")


@query(
    """SELECT page_id, host, position, position * 2 AS start_s FROM (
      SELECT page_id, host, row_number() OVER (PARTITION BY host ORDER BY page_id) - 1 AS position
      FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM pages))"""
)
def fetch_plan(spark, sf):
    return G.fetch_plan(table(spark, sf, "pages"), "page_id").drop("url", "slot")


@query(
    f"""WITH {LINKS} SELECT count(*) AS edges FROM links"""
)
def internal_edges(spark, sf):
    """Page links that stay on their host: here, all of them."""
    found = site_links.page_edges(table(spark, sf, "pages"))
    return G.same_host_edges(found).agg(F.count("*").alias("edges"))
