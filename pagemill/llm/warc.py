"""Web archives: pages written as WARC records, one gzip member each, and read back in byte ranges.

Writing: every task streams its pages to files of its own in the shared folder,
named by task attempt. The files of the attempts that count are the rows of the
returned table; what a lost attempt has left is in no row. Of the pages with
equal payloads of at least ``LEAST_BYTES`` bytes the one with the smallest key
becomes a response, the others are revisit records that refer to it; rows that
share the smallest key are all responses, null keys are never the smallest.

Reading: a task gets a byte range of a file. It looks for the magic bytes of a
gzip member, takes a place for a record only if a WARC header can be decoded
there and the member is whole (checksum and length), and reads on member by
member. It owns the records that start inside its range and reads the last one
to its end, beyond the range if need be. After damage it looks for the next
record. So a file of any size is read by many tasks, and each record once.

Null payloads are empty, and so is a null address. Repeated rows are records of
their own. An empty table gives no file and no record.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from pagemill.llm.batches import chunks, dealt_ranges, values
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

LEAST_BYTES = 100
FILE_BYTES = 256 << 20
RANGE_BYTES = 16 << 20
READ_BYTES = 256 << 10
LONGEST_HEADER = 64 << 10
# Fixed values of the formats: gzip magic with method deflate, header end, profile of revisits by equal payload.
MAGIC = b"\x1f\x8b\x08"
HEADER_END = b"\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILES = StructType([StructField("path", StringType()), StructField("bytes", LongType()), StructField("records", LongType())])
RECORDS = StructType(
    [
        StructField("path", StringType()),
        StructField("offset", LongType()),
        StructField("record_type", StringType()),
        StructField("record_id", StringType()),
        StructField("target_uri", StringType()),
        StructField("refers_to", StringType()),
        StructField("payload_digest", StringType()),
        StructField("payload_bytes", LongType()),
        StructField("payload", BinaryType()),
    ]
)


def page_uri(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def key_of(uri: Column) -> Column:
    """The key in a record's address, null where it has none."""
    return F.regexp_extract(uri, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """A record as one gzip member."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *[f"{k}: {v}" for k, v in fields.items()], f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = "\r\n".join(lines).encode("utf-8") + HEADER_END
    return packer.compress(head + block + HEADER_END) + packer.flush()


def page_record(key: int | None, url: str | None, html: str | None, digest: str, refers_to: int | None, date: str) -> bytes:
    payload = (html or "").encode("utf-8", "replace")
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {
        "WARC-Record-ID": page_uri(key),
        "WARC-Date": date,
        "WARC-Target-URI": quote(url or "", safe=":/?#[]@!$&'()*+,;=%~-._"),
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Type": "application/http;msgtype=response",
    }
    if refers_to is None:
        return record("response", fields, head + payload)
    return record("revisit", fields | {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": page_uri(refers_to)}, head)


def with_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Add ``digest``, the SHA-256 of the payload, and ``refers_to``, the key of the response of a revisit."""
    plain = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.withColumns({"digest": F.sha2(plain.cast("binary"), 256)})
    long = rows.filter(F.octet_length(plain) >= LEAST_BYTES)
    firsts = long.groupBy("digest").agg(F.min(key).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    other = F.col(key).isNull() | (F.col(key) != F.col("first"))
    joined = rows.join(firsts, "digest", "left")
    return joined.withColumn("refers_to", F.when(F.col("first").isNotNull() & other, F.col("first"))).drop("first")


def write_pages(
    pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", date: str = "2020-01-01T00:00:00Z", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write a record for every row below ``folder``, which all executors share; ``path, bytes, records`` of the files.

    ``folder`` is a path or an address that Arrow's file systems can open. The
    table of files is stored, so it can be used again and again.
    """
    spark = pages.sparkSession
    ship_package(spark)
    rows = with_revisits(pages.select(F.col(key).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("html")))
    arrow = to_arrow_schema(FILES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        context = TaskContext.get()
        name = f"{base}/pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        made, out, written, held = [], None, 0, 0
        for batch in batches:
            for part in chunks(batch, "html"):
                columns = (values(part, c) for c in ("page_id", "url", "html", "digest", "refers_to"))
                for number, address, html, digest, refers_to in zip(*columns, strict=True):
                    if out is None:
                        store.create_dir(base, recursive=True)
                        path = f"{name}-{len(made):04d}.warc.gz"
                        out, held = store.open_output_stream(path, compression=None), 0
                        written = out.write(record("warcinfo", {"WARC-Record-ID": f"<urn:file:{len(made)}>", "WARC-Date": date}, b"format: WARC File Format 1.1\r\n"))
                    written += out.write(page_record(number, address, html, digest, refers_to, date))
                    held += 1
                    if written >= file_bytes:
                        out.close()
                        made.append((path, written, held))
                        out = None
        if out is not None:
            out.close()
            made.append((path, written, held))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), arrow, strict=True)], schema=arrow)

    files = rows.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(run, FILES)
    if "://" in folder:  # what a task wrote to is known there by its path alone
        files = files.withColumn("path", F.concat(F.lit(folder.split("://")[0] + "://" + folder.split("://")[1].split("/")[0]), F.col("path")))
    return cut_lineage(files, "archives")


@dataclass
class Member:
    """A decoded gzip member and where it ends."""

    data: bytes
    end: int


class Source:
    """A file read in pieces at any place."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.held = file, size, 0, b""

    def at(self, place: int, count: int) -> bytes:
        """Up to ``count`` bytes from ``place`` on."""
        if not (self.start <= place and place + count <= self.start + len(self.held)):
            self.file.seek(place)
            self.start, self.held = place, self.file.read(max(count, READ_BYTES))
        offset = place - self.start
        return self.held[offset : offset + count]

    def member(self, place: int) -> Member | None:
        """The record that starts at ``place``; nothing if none does or if it is damaged."""
        unpacker, parts, seen, head = zlib.decompressobj(31), [], place, b""
        try:
            while not unpacker.eof:
                raw = self.at(seen, READ_BYTES // 4)
                if not raw:
                    return None
                parts.append(unpacker.decompress(raw))
                seen += len(raw)
                if len(head) < LONGEST_HEADER and HEADER_END not in head:
                    head += parts[-1][:LONGEST_HEADER]
                    if not head.startswith(b"WARC/"[: len(head)]) or (len(head) >= LONGEST_HEADER and HEADER_END not in head):
                        return None
        except zlib.error:
            return None
        data = b"".join(parts)
        fields = header(data)
        if fields is None or not fields.get("content-length", "").isascii() or not fields.get("content-length", "").isdigit():
            return None
        whole = data.index(HEADER_END) + 4 + int(fields["content-length"]) + 4
        return Member(data, seen - len(unpacker.unused_data)) if len(data) == whole and data.endswith(HEADER_END) else None

    def next_magic(self, place: int, stop: int) -> int | None:
        """The first place of the magic bytes from ``place`` on and before ``stop``."""
        while place < stop:
            raw = self.at(place, min(READ_BYTES, stop - place + len(MAGIC) - 1))
            found = raw.find(MAGIC)
            if found >= 0:
                return place + found
            if len(raw) < len(MAGIC):
                return None
            place += len(raw) - len(MAGIC) + 1
        return None


def header(data: bytes) -> dict[str, str] | None:
    """The named fields of a record, names in lower case; none if there is no header."""
    if not data.startswith(b"WARC/") or HEADER_END not in data[:LONGEST_HEADER]:
        return None
    lines = data[: data.index(HEADER_END)].decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def members(source: Source, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """The records that start in a range."""
    place = source.next_magic(start, stop)
    while place is not None:
        found = source.member(place)
        if found is not None:
            yield place, found.data
        place = source.next_magic(found.end if found else place + 1, stop)


def parsed(path: str, offset: int, data: bytes) -> tuple | None:
    """A row of ``RECORDS`` for a response or a revisit, nothing for other records."""
    fields = header(data) or {}
    kind = fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = data[data.index(HEADER_END) + 4 : -4]
    head, _, payload = block.partition(HEADER_END)
    lengths = [v.strip() for k, _, v in (line.partition(b":") for line in head.split(b"\r\n")) if k.strip().lower() == b"content-length"]
    size = len(payload) if kind == "response" else int(lengths[0]) if lengths and lengths[0].isdigit() else None
    digest = fields.get("warc-payload-digest", "").removeprefix("sha256:") or None
    names = ("warc-record-id", "warc-target-uri", "warc-refers-to")
    return path, offset, kind, *(fields.get(n) for n in names), digest, size, payload if kind == "response" else None


def read_records(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The response and revisit records of ``files(path, bytes)``.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: a
    revisit names them, of a response the length is what was read and the digest
    what the record says. ``payload`` is null for a revisit.
    """
    ship_package(spark)
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start")
    ranges = files.filter("bytes > 0").select("path", "bytes", start)
    ranges = dealt_ranges(ranges, "path", "start")
    arrow = to_arrow_schema(RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, begin in zip(*(values(batch, c) for c in ("path", "bytes", "start")), strict=True):
                store, base = pafs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(base) as file:
                    for offset, data in members(Source(file, size), begin, min(size, begin + range_bytes)):
                        row = parsed(path, offset, data)
                        if row is not None:
                            rows.append(row)
                            held += len(data)
                        if held > 4 << 20:
                            yield _table(rows, arrow)
                            rows, held = [], 0
                if rows:
                    yield _table(rows, arrow)

    return ranges.mapInArrow(run, RECORDS)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
