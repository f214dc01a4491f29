"""Jobs over the link graph ``(src, dst)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import urls
from pagemill.operators.ordering import first_per_key, with_index
from pagemill.storage import BucketedTable, cut_lineage

SLOT_DELAY_S = 2  # fixed values: pause between pages of a host, and pages in flight
SLOTS = 5


def same_host_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Edges that stay on their host, for a reach that does not leave it."""
    return edges.filter(urls.host(F.col(src)) == urls.host(F.col(dst)))


def bfs(edges: DataFrame, seeds: DataFrame, max_depth: int, max_pages: int | None = None) -> DataFrame:
    """Nodes reached from the seeds with their least depth, level by level.

    ``edges`` is ``(src, dst)``, ``seeds`` is ``(node)``. Each level is written
    to a scratch table: the plan of the next level stays short, and the join
    strategy is chosen from the level's real size. A hub's edges are split by
    the adaptive skew join. A hub's many links are combined before the shuffle,
    and the nodes visited so far lie in buckets, so a level shuffles only what
    it finds. ``max_pages`` keeps the first nodes by (depth, node).
    """
    return _reach(edges, seeds.select("node"), max_depth, max_pages, None, None, None)


def best_first(
    edges: DataFrame,
    seeds: DataFrame,
    scores: DataFrame,
    beam: int,
    max_depth: int,
    max_pages: int | None = None,
    threshold: float | None = None,
) -> DataFrame:
    """As :func:`bfs`, but only the ``beam`` best new nodes of a level are taken.

    ``scores`` is ``(node, score)``; a node without a score has 0. A single
    priority queue would be serial; the levels here are expanded in parallel,
    so the order of visits may differ from one.
    """
    return _reach(edges, seeds.select("node"), max_depth, max_pages, scores, beam, threshold)


def unseen(found: DataFrame, visited: DataFrame) -> DataFrame:
    """The different nodes of ``found`` that are not in ``visited``, a table in buckets of ``node``."""
    return found.select("node").distinct().join(visited.select("node"), "node", "left_anti")


def _reach(
    edges: DataFrame,
    seeds: DataFrame,
    max_depth: int,
    max_pages: int | None,
    scores: DataFrame | None,
    beam: int | None,
    threshold: float | None,
) -> DataFrame:
    # One type for all nodes: a cast in the join would lose the buckets.
    node_type = seeds.select("node").union(edges.select("dst")).schema["node"].dataType
    links = edges.select("src", F.col("dst").cast(node_type)).filter(F.col("src").isNotNull() & F.col("dst").isNotNull())
    seeds = seeds.select(F.col("node").cast(node_type))
    order: list[str | Column] = ["node"] if scores is None else [F.desc("score"), F.asc("node")]
    extra = [] if scores is None else ["score"]

    def scored(nodes: DataFrame) -> DataFrame:
        if scores is None:
            return nodes
        return nodes.join(scores, "node", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))

    room = max_pages
    level = scored(seeds.filter(F.col("node").isNotNull()).distinct())
    if room is not None:
        level = level.orderBy(*order).limit(room)
    level = cut_lineage(level.select("node", F.lit(0).cast("long").alias("depth"), *extra), "reach")
    reached = level
    visited = BucketedTable(edges.sparkSession, "visited", "node")
    try:
        for depth in range(1, max_depth + 1):
            if room is not None:
                room -= level.count()
                if room <= 0:
                    break
            found = links.join(level.select(F.col("node").alias("src")), "src", "left_semi")
            new = scored(unseen(found.withColumnRenamed("dst", "node"), visited.append(level.select("node"))))
            if threshold is not None:
                new = new.filter(F.col("score") >= threshold)
            width = min(w for w in (beam, room, float("inf")) if w is not None)
            if width != float("inf"):
                new = new.orderBy(*order).limit(int(width))
            level = cut_lineage(new.select("node", F.lit(depth).cast("long").alias("depth"), *extra), "reach")
            if level.isEmpty():
                break
            reached = reached.unionByName(level)
    finally:
        visited.drop()
    return reached


def merge_crawls(old: DataFrame, new: DataFrame, seq: Sequence[str | Column], url: str = "url", **options) -> DataFrame:
    """Results of two runs, one row for each canonical URL; the older run wins."""
    both = old.withColumn("run", F.lit(0)).unionByName(new.withColumn("run", F.lit(1)), allowMissingColumns=True)
    keyed = both.withColumn("canonical_url", urls.canonical(F.col(url), **options))
    return first_per_key(keyed, ["canonical_url"], ["run", *seq])


def fetch_plan(pages: DataFrame, seq: str, delay: int = SLOT_DELAY_S, slots: int = SLOTS, url: str = "url") -> DataFrame:
    """Order, earliest start in seconds and slot of every fetch, host by host.

    Hosts are spread over the slots by hash; the fetches of a host follow each
    other ``delay`` seconds apart.
    """
    hosted = pages.select(seq, url, F.coalesce(urls.host(F.col(url)), F.lit("")).alias("host"))
    ordered = with_index(hosted, seq, ["host"], "position")
    return ordered.withColumns(
        {
            "start_s": F.col("position") * delay,
            "slot": F.pmod(F.xxhash64("host"), F.lit(slots)).cast("long"),
        }
    )
