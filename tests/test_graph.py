"""Reach, similarity and streams against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagemill.operators import aggregates, graph, links, similarity, urls
from pagemill.storage import scratch_path
from pagemill.streaming import jobs


def edge_frame(spark, edges):
    return spark.createDataFrame(edges, "src long, dst long")


def test_bfs_with_a_cycle_and_a_hub(spark):
    rng = random.Random(4)
    edges = [(0, i) for i in range(1, 200)] + [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(5, 0)]
    depth, level = {0: 0}, {0}
    for d in (1, 2, 3):
        level = {b for a, b in edges if a in level} - set(depth)
        depth |= {n: d for n in level}
    seeds = spark.createDataFrame([(0,)], "node long")
    got = {r["node"]: r["depth"] for r in graph.bfs(edge_frame(spark, edges), seeds, 3).collect()}
    assert got == depth
    assert graph.bfs(edge_frame(spark, edges), seeds, 0).count() == 1
    assert graph.bfs(edge_frame(spark, edges), seeds, 3, max_pages=10).count() == 10


def test_best_first_takes_the_beam(spark):
    edges = [(0, i) for i in range(1, 6)] + [(5, 10), (4, 11), (1, 12)]
    scores = spark.createDataFrame([(i, float(i)) for i in range(1, 13)], "node long, score double")
    seeds = spark.createDataFrame([(0,)], "node long")
    got = graph.best_first(edge_frame(spark, edges), seeds, scores, 2, 2, threshold=4.0)
    assert {(r["node"], r["depth"]) for r in got.collect()} == {(0, 0), (5, 1), (4, 1), (10, 2), (11, 2)}


def test_fetch_plan_spaces_a_host(spark):
    frame = spark.createDataFrame([(i, f"https://h{i % 2}/{i}") for i in range(6)], "seq long, url string")
    got = graph.fetch_plan(frame, "seq").orderBy("seq").collect()
    assert [r["start_s"] for r in got] == [0, 0, 2, 2, 4, 4]
    assert len({r["slot"] for r in got if r["host"] == "h0"}) == 1


def vectors(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id long, embedding array<float>")


@pytest.mark.parametrize("threshold, block", [(0.5, 7), (0.85, 7), (0.99, 7), (0.85, 4000)])
def test_near_duplicates_are_exact(spark, monkeypatch, threshold, block):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 8))
    data = [centers[i % 6] + rng.normal(scale=0.35, size=8) for i in range(90)]
    data += [data[4]] * 45 + [data[7] * 3, np.zeros(8)]  # a third are copies of one vector
    data = [np.asarray(v, dtype=np.float32) for v in data]
    ids = rng.permutation(len(data))
    got = similarity.near_duplicates(vectors(spark, zip(ids.tolist(), data)), "id", threshold)
    unit = np.array([v.astype(float) / (np.linalg.norm(v) or 1) for v in data])
    expected = {}
    for i, mine in enumerate(ids):
        same = [other for j, other in enumerate(ids) if other < mine and (unit[i] @ unit[j] >= threshold or (data[i] == data[j]).all())]
        if same:
            expected[int(mine)] = int(min(same))
    assert {r["id"]: r["duplicate_of"] for r in got.collect()} == expected


def test_likely_duplicates_by_bands(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 50)
    rng = np.random.default_rng(5)
    plain = rng.normal(size=(900, 48))
    aside = rng.normal(size=plain.shape)
    aside -= (aside * plain).sum(1, keepdims=True) / (plain**2).sum(1, keepdims=True) * plain
    aside *= np.linalg.norm(plain, axis=1, keepdims=True) / np.linalg.norm(aside, axis=1, keepdims=True)
    cosines = rng.uniform(0.8, 0.99, (900, 1))  # some pairs below the threshold, many just above it
    moved = cosines * plain + np.sqrt(1 - cosines**2) * aside
    data = np.concatenate([plain, moved, np.repeat(plain[:1], 300, axis=0)])
    frame = vectors(spark, enumerate(data))
    exact = {r["id"]: r["duplicate_of"] for r in similarity.near_duplicates(frame, "id", 0.85).collect()}
    got = {r["id"]: r["duplicate_of"] for r in similarity.likely_duplicates(frame, "id", 0.85).collect()}
    assert len(exact) > 800 and got.items() <= exact.items()
    assert len(got) >= 0.95 * len(exact)
    distinct = frame.limit(1800).select("id", F.col("embedding").alias("v"))
    cells = similarity._banded(distinct, 35, 12, 7).groupBy("cell").count().agg(F.sum(F.expr("count * (count - 1) / 2"))).first()[0]
    assert cells < 0.06 * 1800 * 1799 / 2  # a small part of all pairs, all bands together


def test_queries_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pages, queries = rng.normal(size=(40, 5)), rng.normal(size=(7, 5))
    unit = [m / np.linalg.norm(m, axis=1, keepdims=True) for m in (pages, queries)]
    best = (unit[1] @ unit[0].T).max(axis=1)
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 3)
    got = similarity.best_matches(vectors(spark, enumerate(pages)), vectors(spark, enumerate(queries)), "id")
    assert {r["id"]: r["similarity"] for r in got.collect()} == pytest.approx(dict(enumerate(best)), abs=1e-6)


def test_known_crawl_statistics(spark):
    known = [("https://docs.python.org/3/", None, 0)]
    known += [(f"https://docs.python.org/3/tutorial/{i}.html", 0.16, 1 if i == 0 else 2) for i in range(17)]
    known += [(f"https://docs.python.org/3/reference/{i}.html", 0.0, 1 if i == 0 else 2) for i in range(11)]
    frame = spark.createDataFrame(known, "url string, score double, depth int")
    assert [tuple(r) for r in aggregates.pages_by_depth(frame).collect()] == [(0, 1), (1, 2), (2, 26)]
    assert aggregates.mean_score(frame).first()["mean_score"] == pytest.approx(0.09379, abs=1e-5)
    assert aggregates.mean_score(frame.limit(0)).count() == 0


def test_observed_stage_counts_without_a_job(spark):
    frame, seen = aggregates.observe_stage(spark.range(10), "found", top=F.max("id"))
    assert frame.filter("id < 3").count() == 3
    assert seen.get == {"rows": 10, "top": 9}


def test_link_classes(spark):
    rows = [("http://a.example/x", "http://A.example/y"), ("http://a.example/", "http://m.social.example/"), ("http://a.example/", "http://b.example/")]
    frame = spark.createDataFrame(rows, "src string, dst string")
    got = links.classify_links(frame, social=["social.example"])
    assert sorted(r["link_class"] for r in got.collect()) == ["external", "internal", "social"]
    assert links.classify_links(frame, social=["social.example"], keep=["internal"]).count() == 1


def test_dedupe_keeps_the_first_original(spark):
    rows = [(2, "https://h/c?x=___pvid--b_1"), (1, "https://h/c?x=___pvid--a_1"), (3, "https://h/d")]
    frame = spark.createDataFrame(rows, "seq long, url string")
    assert sorted(r["seq"] for r in urls.dedupe_urls(frame, "seq").collect()) == [1, 3]


def test_stream_runs_on_after_a_restart(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    schema = "k string, n long"
    for lot in ([("a", 1), ("a", 2), ("b", 3)], [("a", 4), ("c", 5)]):
        spark.createDataFrame(lot, schema).write.mode("append").parquet(folder)
        stream = jobs.read_stream(spark, folder, spark.createDataFrame([], schema).schema)
        counts = jobs.stream_counts(stream, "k")
        jobs.finish(jobs.run_to_versions(counts, out, checkpoint))
    latest = jobs.latest_versions(spark, out, ["k"], counts.schema)
    assert {r["k"]: r["n"] for r in latest.collect()} == {"a": 3, "b": 1, "c": 1}


def test_stream_dedupe_within_a_watermark(spark):
    folder, out, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    frame = spark.createDataFrame([("a", 1, 0), ("a", 2, 5), ("b", 3, 9)], "k string, n long, s long")
    frame.withColumn("ts", F.timestamp_seconds("s")).write.parquet(folder)
    stream = jobs.read_stream(spark, folder, frame.withColumn("ts", F.timestamp_seconds("s")).schema)
    kept = jobs.stream_dedupe(stream, ["k"], "ts", "1 hour", salts=3).select("k")
    jobs.finish(jobs.run_to_files(kept, out, checkpoint))
    assert sorted(r["k"] for r in spark.read.schema("k string").parquet(out).collect()) == ["a", "b"]


@pytest.mark.parametrize("threshold", [0.3, 0.9])
def test_near_duplicates_in_chunks_and_slices(spark, monkeypatch, threshold):
    """More cells and chunks than fit a task, one of them crowded, and pairs that lie on the threshold."""
    for name, value in (("BLOCK_ROWS", 20), ("COMPARED_ROWS", 16), ("QUERY_BLOCK", 9), ("GRID", 3), ("TASK_ROWS", 60)):
        monkeypatch.setattr(similarity, name, value)
    rng = np.random.default_rng(9)
    data = rng.normal(size=(200, 6))
    data[60:180] = data[3] + rng.normal(scale=0.01, size=(120, 6))
    data[181] = data[180] * 2
    ids = rng.permutation(len(data))
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, data)] + [(None, data[5].tolist())], "id long, embedding array<double>")
    unit = data / np.linalg.norm(data, axis=1, keepdims=True)
    close = (unit @ unit.T >= threshold) & (ids[None, :] < ids[:, None])
    expected = {int(ids[i]): int(ids[close[i]].min()) for i in range(len(ids)) if close[i].any()}
    got = similarity.near_duplicates(frame, "id", threshold).collect()
    assert {r["id"]: r["duplicate_of"] for r in got if r["id"] is not None} == expected


def test_products_at_the_threshold_are_judged_by_whole_vectors(spark):
    """Cosines of 0.6 and a little less, which single precision can't tell apart."""
    rows = [(1, [1.0, 0.0]), (2, [0.6 - 1e-9, 0.8]), (3, [-1.0, 0.0]), (4, [-0.6 - 1e-9, -0.8])]
    frame = spark.createDataFrame(rows, "id long, embedding array<double>")
    for found in (similarity.near_duplicates(frame, "id", 0.6), similarity.likely_duplicates(frame, "id", 0.6, recall=0.9999)):
        assert [tuple(r) for r in found.collect()] == [(4, 3)]


def test_a_vector_travels_a_bounded_number_of_times(spark, monkeypatch):
    """Where nothing can be pruned a vector was sent to every cell; now to as many tasks as either way of dealing has."""
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 5)
    real, sent = similarity._compared, []
    monkeypatch.setattr(similarity, "_compared", lambda dealt, *rest: (sent.append(dealt.count()), real(dealt, *rest))[1])
    rng = np.random.default_rng(2)
    similarity.near_duplicates(vectors(spark, enumerate(rng.normal(size=(400, 8)))), "id", 0.1).count()
    assert sent[0] <= 400 * (2 * similarity.GRID + 8)  # 80 cells
