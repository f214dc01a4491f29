"""The physical plans have the shape the jobs are written for."""

from pyspark.sql import functions as F

from pagemill.operators import graph, html, links, ordering, records, urls
from pagemill.storage import BucketedTable
from pagemill.suite import QUERIES, registry

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_url_filters_reach_the_scan(spark):
    text = plan(urls.filter_globs(registry.table(spark, SF, "pages").select("page_id", "url"), ["https:*"]))
    assert "StringStartsWith(url,https:)" in text and "html" not in text


def test_first_per_key_prunes_before_the_shuffle(spark):
    text = plan(urls.dedupe_urls(registry.table(spark, SF, "pages").select("page_id", "url"), "page_id"))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_visited_nodes_are_not_shuffled(spark):
    visited = BucketedTable(spark, "visited", "node")
    visited.append(spark.range(0, 500).withColumnRenamed("id", "node"))
    seen = visited.append(spark.range(500, 900).withColumnRenamed("id", "node"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = graph.unseen(spark.range(800, 1_000).selectExpr("id % 950 AS node"), seen)
        text = plan(new)
        assert text.count("Exchange") == 1 and "Bucketed: true" in text
        assert text.index("Exchange") < text.index("Bucketed: true")
        assert sorted(r.node for r in new.collect()) == list(range(900, 950))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        visited.drop()
    assert not spark.catalog.tableExists(visited.name)


def test_page_jobs_do_not_shuffle_large_scans(spark, monkeypatch):
    from pagemill import storage

    pages = registry.table(spark, SF, "pages")
    monkeypatch.setattr(storage, "plan_bytes", lambda df: 1 << 40)
    text = plan(html.extract_blocks(pages, "div", "ad"))
    assert "Exchange" not in text and "url" not in text


def test_link_profile_shuffles_once(spark):
    text = plan(QUERIES["link_profile"](spark, SF))
    assert text.count("Exchange") == 1 and "Python" not in text


def test_large_lookup_shuffles_only_cold_keys(spark, monkeypatch):
    monkeypatch.setattr(ordering, "BROADCAST_BYTES", 0)
    events = registry.table(spark, SF, "events").select("user_id", "event_id", "event_type")
    text = plan(records.until_stop(events, "user_id", "event_id", F.col("event_type") == "error"))
    assert "Union" in text and "BroadcastHashJoin" in text


def test_top_links_prunes(spark):
    frame = spark.range(10).select(F.col("id").alias("page_id"), F.lit("u").alias("target"), F.lit(1.0).alias("score"))
    assert "WindowGroupLimit" in plan(links.top_links(frame, 2))


def test_frontier_combines_before_its_only_shuffle(spark):
    pages = registry.table(spark, SF, "pages")
    found = links.resolve_links(links.extract_links(pages)).select("target")
    text = plan(links.frontier(found, pages.select("url"), "target"))
    assert text.count("Exchange") == 1 and text.count("HashAggregate") == 2 and "Join" not in text


def test_links_are_matched_once(spark):
    text = plan(links.extract_links(registry.table(spark, SF, "pages")))
    assert text.count("(?i)<a\\s") == 1 and "size(" not in text


def test_merge_uses_plain_keys(spark):
    frame = spark.range(5).select(F.col("id").alias("page_id"), F.lit("t").alias("title"))
    assert "coalesce(page_id" not in plan(records.merge_records(frame, frame, ["page_id"]))


def test_filters_of_a_chain_are_one_predicate(spark):
    text = plan(QUERIES["filter_chain"](spark, SF))
    assert text.count("Filter") - text.count("Filters") == 1
