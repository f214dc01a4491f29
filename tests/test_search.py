"""The stored search index, observed stages and the state of streams, against their plain forms."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import aggregates, ordering, relevance
from pagemill.storage import scratch_path
from pagemill.streaming import jobs

TEXTS = ["A b, a! c", "b b b", "", None, "c d e f", "a a a a b", ". ; .", "a"]
ASKED = {1: "a b", 2: "Zzz", 3: "c; C d", 4: "", 5: None, 6: "b"}


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_many_queries_are_ranked_as_each_alone(spark, broadcast):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string")
    queries = spark.createDataFrame(list(ASKED.items()), "q long, asked string")
    path = scratch_path(spark, "postings")
    relevance.write_postings(docs, path, "id", partitions=3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        got = relevance.rank_queries(spark.read.parquet(path), queries, "q", "asked", "id", 3).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for number, asked in ASKED.items():
        alone = relevance.rank_pages(docs, [asked], "id").collect() if (asked or "").strip() else []
        expected = sorted(((-round(r.score, 9), r.id) for r in alone))[:3]
        mine = sorted((r["rank"], -r.score, r.id) for r in got if r.q == number)
        assert [(s, i) for _, s, i in mine] == expected
        assert [r for r, _, _ in mine] == list(range(1, len(expected) + 1))


@pytest.mark.parametrize("at_once", [1, 200])
def test_postings_of_documents_with_the_same_key(spark, monkeypatch, at_once):
    monkeypatch.setattr(relevance, "DOCS_AT_ONCE", at_once)
    docs = spark.createDataFrame([(1, "b a b"), (1, "a"), (2, ""), (2, None), (None, "C"), (3, None)], "id long, text string")
    got = sorted((tuple(r) for r in relevance.postings(docs, "id").collect()), key=str)
    assert got == sorted([("a", 1, 2, 3, True), ("b", 1, 2, 3, True), (None, 2, 0, 0, True), ("c", None, 1, 1, True), (None, 3, 0, None, True)], key=str)


def test_words_are_not_gathered_by_a_task(spark, monkeypatch):
    """Postings were aggregated before the shuffle, in a table of all words of a task, and summed up by term."""
    docs = spark.createDataFrame([(i, f"the word{i} a") for i in range(400)], "id long, text string")
    text = relevance.postings(docs, "id")._jdf.queryExecution().executedPlan().toString()
    assert text.index("HashAggregate") < text.index("Exchange") and "HashAggregate" not in text[text.index("Exchange") :]
    path = scratch_path(spark, "postings")
    relevance.write_postings(docs, path, "id")
    monkeypatch.setattr(relevance, "MATCHES_AT_ONCE", 100)
    asked = spark.createDataFrame([(1, "the a"), (2, "the word3")], "q long, asked string")
    found = relevance.rank_queries(spark.read.parquet(path), asked, "q", "asked", "id", 400)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert ", 13), REPARTITION_BY_NUM" in text  # 1,201 matches
    assert found.count() == 800


def test_index_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "id long, text string")
    queries = spark.createDataFrame([(1, "a")], "q long, asked string")
    path = scratch_path(spark, "postings")
    relevance.write_postings(docs, path, "id")
    assert relevance.rank_queries(spark.read.parquet(path), queries, "q", "asked", "id", 3).count() == 0


def test_stages_are_counted_by_the_job_that_writes(spark):
    frame = spark.range(100).withColumn("k", F.col("id") % 7)
    path = scratch_path(spark, "stages")
    stages = [
        ("read", lambda df: df),
        ("odd", lambda df: df.filter("id % 2 = 1")),
        ("unique", lambda df: ordering.first_per_key(df, ["k"], ["id"])),
        ("none", lambda df: df.filter("id < 0")),
    ]
    counts = aggregates.run_stages(frame, stages, lambda df: df.write.parquet(path))
    assert [tuple(r) for r in counts.collect()] == [("read", 100), ("odd", 50), ("unique", 7), ("none", 0)]


def test_open_sessions_are_read_and_stay_open(spark):
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("clicks", "ended", "ended-checkpoint"))
    lots = [[("a", 0), ("a", 10), ("b", 5)], [("a", 25), ("b", 500), ("a", 900)]]
    seen = []
    for lot in lots:
        frame = spark.createDataFrame(lot, "k string, s long").select("k", F.timestamp_seconds("s").alias("ts"))
        frame.write.mode("append").parquet(folder)
        events = jobs.read_stream(spark, folder, frame.schema)
        idle = jobs.stream_idle(events, "k", "ts", "20 seconds", "1 minute")
        jobs.finish(jobs.run_to_files(idle, out, checkpoint))
        ended = spark.read.schema(idle.schema).parquet(out).collect()
        left = jobs.open_sessions(spark, checkpoint, "k").collect()
        seen.append([sorted((r.k, int(r.session_start.timestamp()), r.n_events) for r in rows) for rows in (ended, left)])
    assert seen[0] == [[], [("a", 0, 2), ("b", 5, 1)]]
    assert seen[1] == [[("a", 0, 3), ("b", 5, 1), ("b", 500, 1)], [("a", 900, 1)]]


def test_keys_of_a_bounded_stream_are_forgotten(spark):
    folder, out, checkpoint = (scratch_path(spark, name) for name in ("sent", "once", "once-checkpoint"))
    for lot in range(3):
        rows = [(i, 3600 + i * 60) for i in range(lot * 100, lot * 100 + 100)] * 2
        frame = spark.createDataFrame(rows, "id long, s long").select("id", F.timestamp_seconds("s").alias("ts"))
        frame.write.mode("append").parquet(folder)
        once = jobs.stream_dedupe(jobs.read_stream(spark, folder, frame.schema), ["id"], "ts", "10 minutes")
        jobs.finish(jobs.run_to_files(once, out, checkpoint))
    assert sorted(r.id for r in spark.read.schema(once.schema).parquet(out).collect()) == list(range(300))
    # A key goes 10 minutes after its time, by a watermark that is 10 minutes late: those of the last 20 minutes are left.
    assert spark.read.format("statestore").load(checkpoint).count() == 20
