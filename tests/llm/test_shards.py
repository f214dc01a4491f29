import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from pagemill.llm import shards
from pagemill.llm.queries import QUERIES
from pagemill.storage import scratch_path
from tests.llm.corners import TEXTS, corner_docs, no_docs

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", [1, 2, 3, 7, 256, 1000, 4097])
def test_permutation(size):
    slots = shards.permuted(np.arange(size), size, 5)
    assert sorted(slots.tolist()) == list(range(size))
    assert (shards.permuted(slots, size, 5, back=True) == np.arange(size)).all()
    if size > 200:
        assert (slots != shards.permuted(np.arange(size), size, 6)).any()
        assert abs(np.corrcoef(slots, np.arange(size))[0, 1]) < 0.3


def written(spark, docs, **sizes):
    return shards.write_shards(docs, scratch_path(spark, "shards"), RANKS, public_tokenizers.PATTERN, 20, **sizes)


@pytest.mark.parametrize("length, shard, block", [(16, 8, 40), (1024, 8192, 1 << 17)])
def test_round_trip(spark, monkeypatch, length, shard, block):
    monkeypatch.setattr(shards, "BLOCK", block)
    monkeypatch.setattr(shards, "BUNDLE", 4 * block)
    index = written(spark, corner_docs(spark), length=length, shard=shard)
    rows = {r.slot: np.frombuffer(r.tokens, "<u2") for r in shards.read_shards(spark, index, run_slots=3).collect()}
    known = index.orderBy("slot").collect()
    count = len(rows)
    assert sorted(rows) == list(range(count)) == [r.slot for r in known]
    assert all(r.shard == r.slot // shard for r in known)
    place = shards.permuted(np.arange(count), count, 20)
    stream = np.concatenate([rows[int(s)] for s in place])
    tool = shards.encoding(open(RANKS).read(), public_tokenizers.PATTERN)
    total = sum(r.n_tokens for r in known)
    texts = [p[:-1] for p in np.split(stream[:total], np.flatnonzero(stream[:total] == tool.n_vocab) + 1)][:-1]
    got = [b"".join(map(tool.decode_single_token_bytes, t.tolist())).decode() for t in texts]
    assert sorted(got) == sorted(t or "" for _, t in TEXTS)
    assert (stream[total:] == tool.n_vocab).all() and len(stream) - total < length
    seen = [d for s in place for d in known[int(s)].docs]
    assert set(seen) == {d for d, _ in TEXTS}


def test_reading_goes_on_from_a_slot(spark):
    index = written(spark, spark.read.parquet(f"{SF}/documents.parquet"), length=64, shard=100)
    whole = {r.slot: r.tokens for r in shards.read_shards(spark, index).collect()}
    start = random.Random(1).randrange(len(whole))
    rest = {r.slot: r.tokens for r in shards.read_shards(spark, index, start, 7).collect()}
    assert rest == {s: t for s, t in whole.items() if s >= start}
    read = shards.read_shards(spark, index, run_slots=7)
    assert read.rdd.getNumPartitions() > len(whole) // 7 and read.groupBy(F.spark_partition_id()).count().count() > 20


def test_empty_and_query(spark):
    index = written(spark, no_docs(spark))
    assert index.count() == 0 and shards.read_shards(spark, index).count() == 0
    rows = QUERIES["op7_shards"](spark, SF).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    assert {d for r in rows for d in r.doc_ids} == {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_slots_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(shards, "BLOCK", 2_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id % 3 = 0")).unionByName(docs.filter("doc_id % 9 = 0"))

    def slots(dealt):
        index = written(spark, dealt, length=64, shard=100)
        return {r.slot: (r.n_tokens, r.docs, r.tokens) for r in index.join(shards.read_shards(spark, index), "slot").collect()}

    first = slots(docs.coalesce(1))
    assert len(first) > 500 and first == slots(docs.repartition(5)) == slots(docs.orderBy(F.desc("doc_id")))


@pytest.mark.parametrize("rows", [7, 1_000_000])
def test_texts_start_where_those_before_end(spark, monkeypatch, rows):
    monkeypatch.setattr(shards, "BLOCK", 500)
    docs = spark.range(300).selectExpr("id % 40 AS doc_id", "repeat('word ', cast(id % 40 as int)) AS text").repartition(6)
    blocks = shards.token_blocks(docs, scratch_path(spark, "token-blocks"), RANKS, public_tokenizers.PATTERN)
    texts = [t for r in shards.placed_blocks(blocks, rows).collect() for t in r.texts]
    spans = sorted((t.start + c * t["size"], t["size"], t.doc) for t in texts for c in range(t.copies))
    assert len(spans) == 300
    assert all(a + size == b for (a, size, _), (b, _, _) in zip(spans, spans[1:]))
    marks = {d: shards.order_mark(d, "word " * d) for d in range(40)}
    assert [d for _, _, d in spans] == sorted((d for _, _, d in spans), key=marks.get)
