import random
import re

import pytest
from pyspark.sql import functions as F

from pagemill.llm import vectors
from pagemill.llm.queries import ORACLES, QUERIES
from tests.llm.corners import counted
from tools import check

SF = "/root/testdata/sf0.001"


def expected(rows, k, step):
    whole = [(i, [int(64 * x // 1) for x in v]) for i, v in rows if i is not None and v and all(x is not None and abs(x) < float("inf") for x in v)]
    out = []
    for i, q in whole:
        if i % step == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in whole if j != i)
            out += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k])]
    return out


def test_query(spark):
    connection = check.oracle(SF)
    rows = [tuple(r) for r in QUERIES["op4_vectors"](spark, SF).collect()]
    assert counted(rows) == counted(connection.execute(ORACLES["op4_vectors"]).fetchall())


@pytest.mark.parametrize("block, rows_in_ring", [(256, 512), (7, 5)])
def test_ties_copies_and_bad_vectors(spark, monkeypatch, block, rows_in_ring):
    monkeypatch.setattr(vectors, "RING_ROWS", rows_in_ring)
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = random.Random(1)
    hot = [0.5, -0.25, 1.0]
    rows = [(i, hot if rng.random() < 0.4 else [rng.choice([-1.0, -0.3, 0.0, 0.01, 2.0]) for _ in range(3)]) for i in range(160)]
    rows += [(200, None), (205, []), (210, [float("nan"), 1.0, 1.0]), (215, [float("inf"), 0.0, 0.0]), (220, [None, 1.0, 1.0]), (None, hot), (225, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("q", F.lit("own"))
    got = vectors.top_k(frame, F.col("vec_id") % 5 == 0, 4)
    assert counted(tuple(r) for r in got.collect()) == counted(expected(rows, 4, 5))


def test_few_and_none(spark):
    frame = spark.createDataFrame([(0, [1.0]), (5, [2.0])], "vec_id long, embedding array<double>")
    assert counted(tuple(r) for r in vectors.top_k(frame, F.lit(True)).collect()) == counted([(0, 1, 5, 64 * 128), (5, 1, 0, 64 * 128)])
    assert vectors.top_k(frame.limit(0), F.lit(True)).count() == 0


def test_packed_blocks_are_not_broadcast(spark, monkeypatch):
    """They take few bytes in a file: by its size a table was sent through the driver that is many times as large in memory."""
    frame = spark.createDataFrame([(i, [i / 64, 1.0]) for i in range(300)], "vec_id long, embedding array<double>")
    real, plans = vectors.scored, []

    def scored(*args):
        found = real(*args)
        plans.append(re.search(r"\w+Join", found._jdf.queryExecution().executedPlan().toString()).group())
        return found

    monkeypatch.setattr(vectors, "scored", scored)
    vectors.top_k(frame, F.col("vec_id") % 20 == 0)
    assert plans == ["SortMergeJoin"] * 2  # the last join


def test_sample_is_the_lowest_hashes(spark, monkeypatch):
    rows = [(f"v{i}", [i, i * i % 71, -i]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vid string, q array<long>")
    monkeypatch.setattr(vectors, "SAMPLE", 100)
    index = vectors.fit_index(frame)
    lowest = [r["q"] for r in frame.orderBy(F.xxhash64("vid"), "vid").limit(100).collect()]
    assert index.pivots[0, :3].tolist() == lowest[0] and {tuple(p) for p in index.pivots[:, :3].tolist()} <= {tuple(q) for q in lowest}
