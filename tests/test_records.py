"""Records, captures and files: the rules for missing and false values."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import variants
from pagemill.operators import batches, records
from pagemill.plans import network_log
from pagemill.sources import VENUE, readers, writers
from pagemill.storage import scratch_path


def one(spark, text, name="json"):
    return spark.createDataFrame([(t,) for t in ([text] if isinstance(text, str) else text)], f"{name} string")


@pytest.mark.parametrize(
    "json, error, cleaned",
    [
        ('{"a":1,"error":false}', None, '{"a":1}'),
        ('{"a":1,"error":true}', "true", '{"a":1,"error":true}'),
        ('{"a":1,"error":0}', "0", '{"a":1,"error":0}'),
        ('{"a":1,"error":"false"}', '"false"', '{"a":1,"error":"false"}'),
        ('{"a":1}', None, '{"a":1}'),
    ],
)
def test_only_false_is_dropped(spark, json, error, cleaned):
    row = records.drop_false_error(one(spark, json)).first()
    assert (row["error"], row["json"]) == (error, cleaned)


def test_incomplete_never_claims_a_name(spark):
    rows = [(1, '{"name":"x"}'), (2, '{"name":"x","price":null}'), (3, '{"name":"x","price":1}')]
    frame = spark.createDataFrame(rows, "page long, json string")
    kept = records.complete(frame, ["name", "price"]).withColumn("name", variants.get(variants.parse(F.col("json")), "$.name"))
    assert [r["page"] for r in records.dedupe_records(kept, "name", ["page"]).collect()] == [2]


def test_merge_without_answer_is_the_parsed_record(spark):
    parsed = spark.createDataFrame([(1, 1, "t", 5), (1, 2, "u", 6)], "page_id long, block_no long, title string, units_sold int")
    model = spark.createDataFrame([(1, 1, "", 0)], "page_id long, block_no long, title string, units_sold int")
    got = records.merge_records(parsed, model, ["page_id", "block_no"]).orderBy("block_no").collect()
    assert [tuple(r) for r in got] == [(1, 1, "t", 5), (1, 2, "u", 6)]


def test_capture_shapes(spark):
    texts = [
        '{"url":"a","network_requests":[{"event_type":"request"},7]}',
        '[{"url":"b","network_requests":[{"event_type":"response"}]},3,{"network_requests":{}},{"url":"c"}]',
        '"text"',
        "12",
        "not json",
        "[",
    ]
    got = readers.flatten_captures(one(spark, texts), "json")
    assert sorted((r["page_url"], r["bundle_no"], r["event_no"]) for r in got.collect()) == [("a", 0, 0), ("a", 0, 1), ("b", 0, 0)]


def test_response_rules(spark):
    events = [
        '{"event_type":"response","url":"1","headers":{"content-type":"","Content-Type":"text/html"}}',
        '{"event_type":"response","url":"2","headers":{"content-type":""}}',
        '{"event_type":"response","url":"3","body":null,"headers":null}',
        '{"event_type":"response","url":"4","body":""}',
        '{"event_type":"request","url":"5","body":"x"}',
        '{"event_type":"response","timestamp":1.5,"headers":{"content-type":"a","Content-Type":"b"}}',
        '"noise"',
    ]
    captures = one(spark, '{"network_requests":[' + ",".join(events) + "]}")
    got = network_log.saved_responses(network_log.typed_events(captures, "json").select("event_no", "event"))
    rows = [(r["event_no"], r["url"], r["content_type"], r["timestamp"]) for r in got.orderBy("event_no").collect()]
    assert rows == [(0, "1", "text/html", None), (3, "4", None, None), (5, None, "a", 1.5)]


def test_blocks(spark):
    text = "a\nx\n\n\n b \n\n---\n\nc"
    got = readers.split_blocks(one(spark, text, "text"), "text").orderBy("block_no").collect()
    assert [r["block"] for r in got] == ["a\nx", "b", "---", "c"]
    path = scratch_path(spark, "blocks")
    one(spark, text, "text").write.text(path)
    assert sorted(r["block"] for r in readers.load_blocks(spark, path).collect()) == ["---", "a\nx", "b", "c"]


def test_csv_order_extra_and_empty(spark):
    row = [("d", 3, 4.5, "cap", "5", "loc", "n")]
    frame = spark.createDataFrame(row, "description string, reviews long, rating double, capacity string, price string, location string, name string")
    path = scratch_path(spark, "venues")
    writers.write_csv(frame, path, VENUE)
    assert spark.read.text(path).filter("value like 'name,%'").first()["value"] == "name,location,price,capacity,rating,reviews,description"
    with pytest.raises(ValueError, match="error"):
        writers.write_csv(frame.withColumn("error", F.lit(True)), path, VENUE)
    empty = scratch_path(spark, "none")
    writers.write_csv(frame.limit(0), empty, VENUE)
    assert readers.load_state(spark, empty).isEmpty()


def test_model_output_keeps_raw_lines(spark):
    path = scratch_path(spark, "answers")
    one(spark, ['{"title":"a"}', "sorry, {", '{"title":null}'], "value").write.text(path)
    got = readers.load_model_output(spark, path, T.StructType([T.StructField("title", T.StringType())])).cache()
    assert [r["_corrupt_record"] for r in got.filter("_corrupt_record is not null").collect()] == ["sorry, {"]


def test_prompt_parts(spark):
    frame = spark.createDataFrame([("body {known}", None, "x")], "batch_text string, title string, place string")
    prompt = batches.build_prompts(frame, "A {known}\nB {batch} C", known=["title", "place"]).first()["prompt"]
    assert prompt == 'A {"title":null,"place":"x"}\nB body {known} C'


def test_report_of_a_known_run(spark):
    offered = [f"Starting batch extraction for products {i * 1000 + 1}–{min(i * 1000 + 1000, 14419)}. Appending to x" for i in range(15)]
    written = [f"✅ Batch {b} complete. Wrote {n} products." for b, n in zip((2, 3, 5, 6, 14, 15), (243, 247, 229, 193, 281, 227))]
    failed = ["❌ Batch 1 failed. Error: 429 RESOURCE_EXHAUSTED. {}"] * 5 + ["⚠️ Failed to parse JSON, writing raw text instead."] * 4
    row = batches.batch_report(one(spark, offered + written + failed + ["   Prompt Feedback: None"], "line")).first()
    assert (row["batches"], row["offered"], row["batches_written"], row["written"]) == (15, 14419, 6, 1420)
    assert (row["failed_quota"], row["failed_json"], row["failed_other"]) == (5, 4, 0)


def test_chunks_end_with_the_text(spark):
    frame = one(spark, " ".join(str(i) for i in range(10)), "text")
    got = [r["chunk"] for r in batches.chunk_text(frame, 4, 1).orderBy("chunk_no").collect()]
    assert got == ["0 1 2 3", "3 4 5 6", "6 7 8 9"]
    with pytest.raises(ValueError):
        batches.chunk_text(frame, 4, 4)
