"""A bounded best-first reach over the stored link graph, saved and reported."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.functions import urls
from pagemill.operators import graph


def scored_reach(
    edges: DataFrame, seeds: DataFrame, keywords: Sequence[str], weight: float, beam: int, max_depth: int
) -> DataFrame:
    """``(url, score, depth)`` as in a crawl result list; the seed's score is 0."""
    nodes = edges.select(F.col("dst").alias("node")).distinct()
    scores = nodes.select("node", urls.keyword_score(F.col("node"), keywords, weight).alias("score"))
    reached = graph.best_first(edges, seeds, scores, beam, max_depth)
    score = F.when(F.col("depth") == 0, F.lit(0.0)).otherwise(F.col("score"))
    return reached.select(F.col("node").alias("url"), score.alias("score"), F.col("depth").cast("int").alias("depth"))
