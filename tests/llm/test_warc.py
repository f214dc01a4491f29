import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from pagemill.llm import warc
from pagemill.llm.queries import ORACLES, QUERIES
from pagemill.storage import scratch_path
from tests.llm.corners import counted
from tools import check

SF = "/root/testdata/sf0.001"
PAGES = [
    (1, "http://a/1", "<p>same</p>" * 20),
    (2, "http://a/ü b\r\nX: y", "<p>same</p>" * 20),
    (3, None, "<p>same</p>" * 20),
    (None, "http://a/n", "<p>same</p>" * 20),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "short"),
    (7, "http://a/7", "short"),
    (8, "http://a/8", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9),
    (9, "http://a/9", "long 漢 " * 40_000),
    (1, "http://a/1", "<p>same</p>" * 20),
]


def test_query(spark):
    connection = check.oracle(SF)
    rows = QUERIES["op5_warc"](spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    expected = connection.execute(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({ORACLES['op5_warc']})").fetchall()
    assert counted(tuple(r) for r in rows) == counted(expected)


@pytest.mark.parametrize("range_bytes", [1, 37, 500, 1 << 24])
def test_every_record_once_in_any_ranges(spark, range_bytes):
    if range_bytes == 1:
        rows = PAGES[:3]
    else:
        rows = PAGES
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("own")).repartition(2)
    files = warc.write_pages(pages, scratch_path(spark, "warc"), file_bytes=300)
    got = warc.read_records(spark, files, range_bytes).collect()
    assert sum(r.records for r in files.collect()) == len(rows) == len(got)
    for r in got:
        if r.record_type == "response":
            assert hashlib.sha256(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    same = {r.record_id: (r.record_type, r.refers_to) for r in got if r.payload_bytes == 220}
    assert same["<urn:page:1>"] == ("response", None)
    assert {k for k, v in same.items() if v == ("revisit", "<urn:page:1>")} == set(same) - {"<urn:page:1>"}


def test_reading_uses_a_task_a_range(spark):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 400) for i in range(40)], "page_id long, url string, html string")
    files = warc.write_pages(pages, scratch_path(spark, "warc"), file_bytes=600)
    ranges = sum(-(-r.bytes // 200) for r in files.collect())
    found = warc.read_records(spark, files, 200)
    assert found.rdd.getNumPartitions() == ranges > 20
    assert found.groupBy(F.spark_partition_id()).count().count() > 10 and found.count() == 40


def test_members_are_plain_gzip_and_damage_is_skipped(spark, tmp_path):
    records = [warc.page_record(i, "u", f"page {i}" * 50, "d", None, "2020-01-01T00:00:00Z") for i in range(5)]
    assert gzip.decompress(b"".join(records)).count(b"WARC/1.1") == 5
    broken = bytearray(b"junk\x1f\x8b\x08" + b"".join(records))
    at = 7 + len(records[0]) + len(records[1]) // 2
    broken[at] ^= 255
    path = tmp_path / "x.warc.gz"
    path.write_bytes(bytes(broken))
    with open(path, "rb") as file:
        found = [data for _, data in warc.members(warc.Source(file, len(broken)), 0, len(broken))]
    assert [warc.parsed("x", 0, d)[3] for d in found] == [f"<urn:page:{i}>" for i in (0, 2, 3, 4)]


def test_no_pages(spark):
    files = warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), scratch_path(spark, "warc"))
    assert files.count() == 0 and warc.read_records(spark, files).count() == 0
