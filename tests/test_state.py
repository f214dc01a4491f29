"""The keyed state of a stream, and windows that close."""

import os

from pyspark.sql import functions as F

from pagemill.streaming import jobs
from pagemill.streaming.state import read_state, upsert

SCHEMA = "k long, n long, text string"


def rows_of(spark, path):
    return sorted(map(tuple, read_state(spark, path, spark.createDataFrame([], SCHEMA).schema).collect()), key=repr)


def test_many_batches_leave_few_files(spark, tmp_path):
    path, expected = f"file://{tmp_path}/state", {}
    for batch in range(20):
        rows = [(k, batch * 10 + place, f"t{batch}") for place, k in enumerate([batch % 7, batch % 3, None, 100 + batch // 5, batch % 7])]
        expected |= {r[0]: r for r in rows}
        upsert(spark.createDataFrame(rows, SCHEMA).coalesce(1), batch, path, ["k"], F.col("n"), buckets=3)
    assert rows_of(spark, path) == sorted(expected.values(), key=repr)
    files = [f for _, _, names in os.walk(tmp_path / "state") for f in names if f.endswith((".parquet", ".json"))]
    assert len(files) <= 2 * 3 + 4


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    frame = lambda rows: spark.createDataFrame(rows, SCHEMA)
    upsert(frame([(1, 1, "a"), (2, 1, "b"), (1, 0, "old")]), 0, path, ["k"], F.col("n"), buckets=2)
    upsert(frame([(2, 2, "c"), (3, 2, "d")]), 1, path, ["k"], F.col("n"), buckets=2)
    whole = [(1, 1, "a"), (2, 2, "c"), (3, 2, "d")]
    assert rows_of(spark, path) == whole
    upsert(frame([(2, 2, "c"), (3, 2, "d")]), 1, path, ["k"], F.col("n"), buckets=2)
    assert rows_of(spark, path) == whole
    upsert(frame([]), 2, path, ["k"], F.col("n"), buckets=2)
    assert rows_of(spark, path) == whole
    assert rows_of(spark, f"file://{tmp_path}/none") == []


def test_late_rows_are_left_out_and_counted(spark, tmp_path):
    folder, out, checkpoint = (f"file://{tmp_path}/{n}" for n in ("in", "out", "checkpoint"))
    rows = [(f"2024-01-01 0{h}:{m:02d}:00", "a" if m % 2 else "b") for h in range(8) for m in range(0, 60, 7)]
    frame = spark.createDataFrame(rows, "at string, kind string").select(F.to_timestamp("at").alias("ts"), "kind")
    arrived = []
    for lot in (frame, frame.filter("ts < '2024-01-01 02:00:00'")):
        lot.coalesce(1).write.mode("append").parquet(folder)
        counts = jobs.window_counts(jobs.read_stream(spark, folder, frame.schema), "ts", "1 hour", "2 hours", "kind")
        query = jobs.run_to_files(counts, out, checkpoint)
        jobs.finish(query)
        arrived.append(jobs.arrived_rows(query))
    got = spark.read.parquet(out)
    expected = {h: sum(int(at[11:13]) == h for at, _ in rows) for h in range(5)}  # the watermark stands at 05:56
    assert {r[0].hour: r[1] for r in got.groupBy("window_start").agg(F.sum("n")).collect()} == expected
    assert arrived == [72, 18]
