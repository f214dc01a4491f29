"""Headline queries, the median of three timings each after a warm-up, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pagemill.session import local_session  # noqa: E402
from pagemill.suite import QUERIES  # noqa: E402

HEADLINE = (
    "load_pages load_captures block_split flatten_capture csv_roundtrip jsonl_roundtrip markdown_export "
    "url_regex_filter url_glob_filter domain_filter filter_chain canonical_url dedupe_urls resolve_links classify_links "
    "link_profile extract_links extract_blocks extract_schema table_cells spec_cells extract_jsonld extract_cards catalogue_products "
    "fix_images page_profile html_to_text html_to_markdown "
    "complete_distinct dedupe_records merge_records to_product split_responses until_stop response_events listed_records "
    "fixed_batches pack_batches chunk_text batch_report "
    "event_counts api_calls resource_histogram error_samples idle_sessions "
    "bfs_depth best_first frontier merge_crawls fetch_plan "
    "keyword_score rank_pages adaptive_stats visited_pages embedding_coverage near_duplicates "
    "stream_scores stream_counts stream_dedupe stream_idle stream_resume"
).split()


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds to build the query and to compute every row and column of it."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "pagemill-bench")
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            run(spark, name, warm_dir)
    seconds = {name: round(median(run(spark, name, sf_dir) for _ in range(3)), 3) for name in HEADLINE}
    spark.stop()
    report = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
