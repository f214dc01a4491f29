"""Token ids in training order, in binary files of fixed stride.

The token ids of all documents, each followed by an end mark, are one stream.
It is cut into sequences of the same length, and a keyed permutation gives
every sequence its slot: a Feistel network over the next even number of bits,
applied again until the result is below the number of sequences. Neighbours of
the stream so end up anywhere, the order is known from the key alone, and both
directions are computed without a table.

A file holds the slots of one range: a header and then sequence after sequence,
so the place of a slot is a multiplication, and a reader that has stopped goes
on from the next slot. A task that writes gets all pieces of a file; its size is
fixed. Files are named by task attempt, and the returned table names those that
count.

The stream's order is that of a 128-bit hash of key and text, so it doesn't
depend on how the rows are dealt to files and tasks. Texts are encoded once, to
compressed blocks in files of the shared folder. Only a row a document, with
its hash and number of tokens, is sorted to find where it starts; the blocks are
then read where they lie. Pieces travel in compressed bundles, since token ids
are most of what is moved.

Null and empty texts are the end mark alone. Rows that repeat key and text are
each in the stream; a block stores the tokens of those it holds once. The last
sequence is filled up with end marks. An empty table gives no file.
"""

from __future__ import annotations

import base64
import struct
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from pagemill.llm.batches import MOST_TASKS, chunks, dealt_ranges, values
from pagemill.operators.ordering import with_running_sums
from pagemill.session import ship_package
from pagemill.storage import cut_lineage, drop_scratch, scratch_path

SEQUENCE = 1_024
SHARD = 8_192  # sequences a file
BLOCK = 128 << 10  # tokens a stored block
BUNDLE = 8 << 20  # tokens a task sorts by file before it passes them on
SORTED, MOST_SORTS = 1 << 16, 10_000  # texts a task puts in order, and parts of the order
ROUNDS = 6
HEADER, HEADER_BYTES = "<8sIIQQ32x", 64  # magic, tokens a sequence, bytes a token, first slot, sequences
MAGIC = b"TOKSHARD"
PIECE, PIECE_BYTES = "<QIIq?", 25  # slot, place, tokens, document, whether its key is null

TEXT = StructType([StructField("high", LongType()), StructField("low", LongType()), StructField("doc", LongType()), StructField("size", LongType()), StructField("copies", LongType())])
BLOCKS = StructType([StructField("path", StringType()), StructField("at", LongType()), StructField("stored", LongType()), StructField("texts", ArrayType(TEXT))])
PIECES = StructType([StructField("shard", LongType()), StructField("pieces", BinaryType())])
INDEX = StructType(
    [StructField("slot", LongType()), StructField("shard", LongType()), StructField("path", StringType()), StructField("n_tokens", IntegerType()), StructField("docs", ArrayType(LongType()))]
)


def _round_keys(key: int) -> list[int]:
    return [xxhash.xxh64_intdigest(struct.pack("<Q", r), key & 0xFFFFFFFFFFFFFFFF) for r in range(ROUNDS)]


def _mix(half: np.ndarray, key: int) -> np.ndarray:
    x = (half + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def permuted(numbers: np.ndarray, size: int, key: int, back: bool = False) -> np.ndarray:
    """The slot of every number below ``size``; with ``back`` the number of every slot."""
    if size <= 1:
        return numbers.astype(np.int64)
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _round_keys(key)
    result = numbers.astype(np.uint64)
    todo = np.arange(len(result))
    while len(todo):
        left, right = result[todo] >> half, result[todo] & mask
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (_mix(left, k) & mask), left
            else:
                left, right = right, left ^ (_mix(right, k) & mask)
        result[todo] = (left << half) | right
        todo = todo[result[todo] >= np.uint64(size)]
    return result.astype(np.int64)


@lru_cache(maxsize=2)
def encoding(ranks: str, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(a): int(b) for a, b in map(str.split, ranks.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def order_mark(number: int | None, text: str) -> tuple[int, int]:
    """The place of a text in the order of the stream, as two signed numbers."""
    known = b"" if number is None else struct.pack("<q", number)
    return struct.unpack("<qq", xxhash.xxh3_128_digest(bytes([len(known)]) + known + text.encode()))


def token_blocks(docs: DataFrame, folder: str, ranks_path: str, pattern: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """Write the tokens in blocks below ``folder``; where each block lies, and its texts with order, document, tokens and copies.

    ``ranks_path`` is a file of byte pairs and ranks, read by the driver. Its
    first free id is the end mark. Ids below 2^16 take two bytes.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Path(ranks_path).read_text(encoding="ascii"))
    arrow = to_arrow_schema(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoding(shared.value, pattern)
        kind, end = token_type(tool.n_vocab + 1), tool.n_vocab
        packer, out, at, held = zstandard.ZstdCompressor(level=3), None, 0, 0
        texts: dict[tuple[int, int], list[int]] = {}
        parts: list[bytes] = []

        def block() -> pa.RecordBatch:
            nonlocal out, path, at
            if out is None:
                files, base = pafs.FileSystem.from_uri(folder)
                files.create_dir(base, recursive=True)
                path = f"tokens-{TaskContext.get().taskAttemptId()}.bin"
                out = files.open_output_stream(f"{base}/{path}", compression=None)
            data = packer.compress(b"".join(parts))
            out.write(data)
            found = [[*mark, *text] for mark, text in texts.items()]
            row = [[path], [at], [len(data)], [[dict(zip(TEXT.names, t, strict=True)) for t in found]]]
            at += len(data)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, arrow, strict=True)], schema=arrow)

        path = ""
        try:
            for batch in batches:
                for piece in chunks(batch, column):
                    for number, text in zip(values(piece, "key"), values(piece, column), strict=True):
                        mark = order_mark(number, text or "")
                        if mark in texts:
                            texts[mark][2] += 1
                        else:
                            ids = tool.encode_ordinary(text or "")
                            ids.append(end)
                            texts[mark] = [number, len(ids), 1]
                            parts.append(np.array(ids, kind).tobytes())
                        held += texts[mark][1]
                        if held >= BLOCK:
                            yield block()
                            texts, parts, held = {}, [], 0
            if held:
                yield block()
        finally:
            if out is not None:
                out.close()

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(column).alias(column)).mapInArrow(run, BLOCKS)
    return cut_lineage(rows, "tokens")


def placed_blocks(blocks: DataFrame, rows: int = SORTED) -> DataFrame:
    """A row a block: where it lies, and its texts in the order they are stored with the token that the first copy starts at."""
    texts = blocks.select("path", "at", "stored", F.posexplode("texts").alias("pos", "text")).select("path", "at", "stored", "pos", "text.*")
    # Copies in other blocks have the same hash and tokens, so it doesn't matter which of them is first.
    order = ["high", "low", "path", "at"]
    # A hash is spread evenly, so the parts need no quantiles.
    parts = min(-(-(blocks.agg(F.sum(F.size("texts"))).first()[0] or 0) // rows), MOST_SORTS)
    cuts = [-(2.0**63) + i * (2.0**64 / parts) for i in range(1, parts)]
    summed = with_running_sums(texts, order, {"stop": F.col("size") * F.col("copies")}, cuts=cuts)
    start = F.col("stop") - F.col("size") * F.col("copies")
    text = F.struct("pos", "doc", "size", "copies", start.alias("start"))
    # A task's blocks make a bundle. A block holds a bounded number of texts.
    tasks = max(1, min(-(-blocks.count() // max(1, BUNDLE // BLOCK)), MOST_TASKS))
    dealt = summed.select("path", "at", "stored", text.alias("text")).repartition(tasks, "path", "at")
    return dealt.groupBy("path", "at", "stored").agg(F.sort_array(F.collect_list("text")).alias("texts"))


def token_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2" if vocabulary <= 1 << 16 else "<u4")


def cut_texts(texts: list[dict], length: int) -> tuple[np.ndarray, ...]:
    """Every text's copies cut where sequences end: sequence, place in it, tokens, first token in the block, text."""
    copies, sizes = (np.array([t[c] for t in texts], np.int64) for c in ("copies", "size"))
    text = np.repeat(np.arange(len(texts)), copies)
    copy = np.arange(len(text)) - np.repeat(np.cumsum(copies) - copies, copies)
    starts = np.array([t["start"] for t in texts], np.int64)[text] + copy * sizes[text]
    stops = starts + sizes[text]
    firsts = starts // length
    counts = (stops - 1) // length - firsts + 1
    of = np.repeat(np.arange(len(text)), counts)
    sequence = firsts[of] + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = np.maximum(sequence * length, starts[of])
    ends = np.minimum((sequence + 1) * length, stops[of])
    stored = (np.cumsum(sizes) - sizes)[text[of]] + begins - starts[of]
    return sequence, begins - sequence * length, ends - begins, stored, text[of]


def shard_pieces(blocks: DataFrame, folder: str, sequences: int, kind: np.dtype, key: int, length: int, shard: int) -> DataFrame:
    """Bundles of pieces for every file: slot, place in the sequence, document and token ids."""
    arrow = to_arrow_schema(PIECES)

    def bundles(held: dict[int, list[bytes]], packer: zstandard.ZstdCompressor) -> pa.RecordBatch:
        columns = [list(held), [packer.compress(b"".join(p)) for p in held.values()]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, unpacker = zstandard.ZstdCompressor(level=6), zstandard.ZstdDecompressor()
        files, base = pafs.FileSystem.from_uri(folder)
        held: dict[int, list[bytes]] = defaultdict(list)
        waiting = 0
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                with files.open_input_file(f"{base}/{row['path']}") as file:
                    file.seek(row["at"])
                    raw = unpacker.decompress(file.read(row["stored"]))
                cuts = cut_texts(row["texts"], length)
                slots = permuted(cuts[0], sequences, key)
                for slot, place, size, begin, text in zip(slots.tolist(), *(c.tolist() for c in cuts[1:]), strict=True):
                    number = row["texts"][text]["doc"]
                    head = struct.pack(PIECE, slot, place, size, number or 0, number is None)
                    held[slot // shard].append(head + raw[begin * kind.itemsize : (begin + size) * kind.itemsize])
                    waiting += size
                    if waiting >= BUNDLE:
                        yield bundles(held, packer)
                        held.clear()
                        waiting = 0
        if held:
            yield bundles(held, packer)

    return blocks.mapInArrow(run, PIECES)


def write_shards(
    docs: DataFrame, folder: str, ranks_path: str, pattern: str, seed: int, key: str = "doc_id", column: str = "text", length: int = SEQUENCE, shard: int = SHARD
) -> DataFrame:
    """Write the files below ``folder``, which all executors share; ``slot, shard, path, n_tokens, docs`` of every sequence.

    ``n_tokens`` is less than ``length`` only for the sequence that was filled
    up; ``docs`` are the documents with tokens in it, in order. The table is stored.
    """
    spark = docs.sparkSession
    tokens = scratch_path(spark, "token-blocks")
    blocks = token_blocks(docs, tokens, ranks_path, pattern, key, column)
    end = encoding(Path(ranks_path).read_text(encoding="ascii"), pattern).n_vocab
    kind = token_type(end + 1)
    held = F.aggregate("texts", F.lit(0).cast("long"), lambda n, t: n + t["size"] * t["copies"])
    total = blocks.agg(F.sum(held)).first()[0] or 0
    sequences = -(-total // length)
    pieces = shard_pieces(placed_blocks(blocks), tokens, sequences, kind, seed, length, shard)
    arrow = to_arrow_schema(INDEX)

    def store(number: int, bundles: list[bytes]) -> pa.RecordBatch:
        first = number * shard
        count = min(shard, sequences - first)
        tokens = np.full((count, length), end, kind)
        filled, owners = np.zeros(count, np.int64), [[] for _ in range(count)]
        unpacker = zstandard.ZstdDecompressor()
        for bundle in bundles:
            data, at = unpacker.decompress(bundle), 0
            while at < len(data):
                slot, place, size, doc, unknown = struct.unpack_from(PIECE, data, at)
                at += PIECE_BYTES
                tokens[slot - first, place : place + size] = np.frombuffer(data, kind, size, at)
                at += size * kind.itemsize
                filled[slot - first] += size
                owners[slot - first].append((place, None if unknown else doc))
        if (filled < length).sum() > 1 or int(filled.sum()) == 0:
            raise ValueError(f"file {number} lacks tokens")
        files, base = pafs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        path = f"{base}/shard-{number:08d}-{TaskContext.get().taskAttemptId()}.bin"
        with files.open_output_stream(path, compression=None) as out:
            out.write(struct.pack(HEADER, MAGIC, length, kind.itemsize, first, count))
            out.write(tokens.tobytes())
        docs_of = [[d for _, d in sorted(o, key=lambda x: x[0])] for o in owners]
        columns = [np.arange(first, first + count), [number] * count, [path] * count, filled, docs_of]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, bundles = None, []
        for batch in batches:
            for shard_no, bundle in zip(values(batch, "shard"), values(batch, "pieces"), strict=True):
                if shard_no != number and bundles:
                    yield store(number, bundles)
                    bundles = []
                number = shard_no
                bundles.append(bundle)
        if bundles:
            yield store(number, bundles)

    # A task a file up to a bound; no sample is drawn, which would cut all texts twice.
    files_a_task = max(1, -(-sequences // shard // MOST_TASKS))
    tasks = max(1, -(-sequences // (shard * files_a_task)))
    dealt = pieces.repartitionById(tasks, F.floor(F.col("shard") / files_a_task).cast("int")).sortWithinPartitions("shard")
    index = dealt.mapInArrow(run, INDEX)
    if "://" in folder:
        scheme, _, rest = folder.partition("://")
        index = index.withColumn("path", F.concat(F.lit(f"{scheme}://{rest.split('/')[0]}"), F.col("path")))
    written = cut_lineage(index, "index")
    if total:
        files, base = pafs.FileSystem.from_uri(tokens)
        files.delete_dir(base)
    drop_scratch(blocks)
    return written


def read_shards(spark: SparkSession, index: DataFrame, first_slot: int = 0, run_slots: int = 1_024) -> DataFrame:
    """``slot, tokens`` from ``first_slot`` on, tokens as binary; a task reads runs of ``run_slots`` neighbours."""
    ship_package(spark)
    files = index.filter(F.col("slot") >= first_slot).groupBy("path").agg(F.min("slot").alias("low"), F.max("slot").alias("high"))
    runs = files.select("path", "high", F.explode(F.sequence("low", "high", F.lit(run_slots).cast("long"))).alias("low"))
    schema = StructType([StructField("slot", LongType()), StructField("tokens", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, low, high in zip(*(values(batch, c) for c in ("path", "low", "high")), strict=True):
                files, base = pafs.FileSystem.from_uri(path)
                with files.open_input_file(base) as file:
                    magic, length, width, first, count = struct.unpack(HEADER, file.read(HEADER_BYTES))
                    if magic != MAGIC:
                        raise ValueError(f"{path} holds no sequences")
                    stride, last = length * width, min(high, low + run_slots - 1, first + count - 1)
                    file.seek(HEADER_BYTES + (low - first) * stride)
                    data = file.read((last - low + 1) * stride)
                rows = [data[i : i + stride] for i in range(0, len(data), stride)]
                yield pa.RecordBatch.from_arrays([pa.array(range(low, last + 1), pa.int64()), pa.array(rows, arrow.field(1).type)], schema=arrow)

    return dealt_ranges(runs, "path", "low").mapInArrow(run, schema)
