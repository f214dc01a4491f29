"""Removal of repeated substrings by a column-wise suffix order of many documents.

Every byte covered by a string of ``LENGTH`` bytes that starts in two places, in
any documents, is removed. The places that can match are found first. Of each
window of ``LENGTH`` bytes the run of ``GRAM`` bytes with the least hash is its
anchor, so equal windows have equal anchors at the same place inside; about one
byte in ``(LENGTH - GRAM) / 2`` is an anchor. Only anchors that occur twice
matter, with their context: all windows that contain the anchor.

Contexts that are equal as a whole need no more: all their windows repeat. The
different contexts of an anchor are short strings, one document each, aligned
at the anchor. They are sorted column by column from the right: each round puts
one more symbol before every string, in the order of the suffixes so far (that
column of symbols is the strings' Burrows-Wheeler transform), sorts stably by
it and updates the common prefixes of neighbours. A window repeats if its common
prefix with a neighbour reaches ``LENGTH``. A task does this for many anchors at
once, in memory that is bounded: it takes ``ROUND_STRINGS`` strings together.
An anchor with more than ``CROWD`` different contexts is split first: windows
that start near each other have a long core in common, and only contexts with
the same core are compared, for those windows alone. Of contexts that are equal
in all these windows one goes on, and a group that stays large is split on.
Only hashes are moved for that.

Null texts are empty. Texts shorter than ``LENGTH`` lose nothing. Rows with the
same key and text are two documents, so such a text of ``LENGTH`` bytes or more
is removed as a whole from both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from pagemill.llm.batches import chunks, free_name, values
from pagemill.operators.ordering import null_safe_join
from pagemill.session import ship_package
from pagemill.storage import cut_lineage, drop_scratch

LENGTH = 400
GRAM = 100
CROWD = 1_024
ROUND_STRINGS = 8_192
PARTS = 8
PIECE = 1 << 20  # window starts looked at together
BASE = 0x9E3779B97F4A7C15  # odd: the multiplier of the rolling hash
PAD = 256  # a symbol that is no byte


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(count, BASE, np.uint64)
    down = np.full(count, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


_UP, _DOWN = _powers(PIECE + 4096)


def rolling(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` bytes; at most ``PIECE + 4096`` bytes."""
    count = len(data) - gram + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[: len(data)], out=sums[1:])
    mixed = (sums[gram:] - sums[:count]) * _DOWN[:count]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(29))


def sliding_least(numbers: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours: block-wise minima from the left and from the right."""
    count = len(numbers) - width + 1
    full = -(-len(numbers) // width) * width
    padded = np.full(full, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(numbers)] = numbers
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:count], left[width - 1 : width - 1 + count])


def anchors(data: np.ndarray, stops: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of texts that lie end to end, ending at ``stops``."""
    ends = np.repeat(stops, np.diff(stops, prepend=0))
    places, hashes = [], []
    for a in range(0, max(0, len(data) - length + 1), PIECE):
        part = data[a : a + PIECE + length - 1]
        grams = rolling(part, gram)
        packed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
        least = sliding_least(packed, length - gram + 1)
        starts = a + np.arange(len(least))
        inside = starts + length <= ends[starts]
        at = np.unique(least[inside] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        places.append(at + a)
        hashes.append(grams[at].view(np.int64))
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def repeated_windows(strings: list[bytes], lefts: np.ndarray, group: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """For every string and every offset before the anchor: does that window occur in another string of its group?

    String ``i`` has ``lefts[i]`` bytes before its anchor, at most ``length -
    gram``; column ``c`` of the result is the window that starts ``length -
    gram - c`` bytes before it. ``group`` is ascending.
    """
    reach = length - gram
    columns, n = reach + length, len(strings)
    matrix = np.full((columns, n), PAD, np.int32)
    for i, string in enumerate(strings):
        first = reach - int(lefts[i])
        matrix[first : first + len(string), i] = np.frombuffer(string, np.uint8)
    result = np.zeros((n, reach + 1), bool)
    order, common = np.arange(n), np.zeros(n + 1, np.int32)
    base = group.astype(np.int64) * (PAD + 1)
    for c in range(columns - 1, -1, -1):
        symbol = base + matrix[c][order]
        moved = np.argsort(symbol, kind="stable")
        sorted_symbol, order = symbol[moved], order[moved]
        new = np.zeros(n + 1, np.int32)
        same = np.flatnonzero(sorted_symbol[1:] == sorted_symbol[:-1]) + 1
        low, high = moved[same - 1] + 1, moved[same] + 1
        value = common[high - 1]
        apart = np.flatnonzero(high - low > 1)
        if len(apart):
            apart = apart[np.argsort(low[apart], kind="stable")]
            limits = np.column_stack([low[apart], high[apart]]).ravel()
            value[apart] = np.minimum.reduceat(common, limits)[::2]
        new[same] = value + 1
        common = new
        if c <= reach:
            long = common >= length
            result[order, c] = long[:-1] | long[1:]
    return result


def runs(row: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of every run of true."""
    edges = np.flatnonzero(np.diff(row.astype(np.int8), prepend=0, append=0))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans put together where they meet or overlap."""
    result: list[list[int]] = []
    for start, stop in sorted(spans):
        if result and start <= result[-1][1]:
            result[-1][1] = max(result[-1][1], stop)
        else:
            result.append([start, stop])
    return [(a, b) for a, b in result]


PLACE = [StructField("pos", IntegerType()), StructField("left", IntegerType()), StructField("right", IntegerType())]
HASHES = [StructField("anchor", LongType()), StructField("context", LongType())]
RANGE = [StructField("low", IntegerType()), StructField("high", IntegerType())]
SPAN = [StructField("start", IntegerType()), StructField("stop", IntegerType())]
OWNER = ["key", "text_hash"]


def _rows(arrow: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def anchor_rows(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``key, text_hash, pos, left, right, anchor, context`` of the anchors of all texts."""
    schema = StructType([*[texts.schema[c] for c in OWNER], *PLACE, *HASHES])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", PIECE):
                raw = [(t or "").encode("utf-8", "replace") for t in values(part, "text")]
                joined = b"".join(raw)
                stops = np.cumsum([len(r) for r in raw])
                place, digest = anchors(np.frombuffer(joined, np.uint8), stops, length, gram)
                if not len(place):
                    continue
                row = np.searchsorted(stops, place, side="right")
                begins, ends = (stops - [len(r) for r in raw])[row], stops[row]
                left, right = np.minimum(place - begins, length - gram), np.minimum(ends - place, length)
                context = [
                    xxhash.xxh64_intdigest(joined[p - a : p + b], a * (length + 1) + b)
                    for p, a, b in zip(place.tolist(), left.tolist(), right.tolist(), strict=True)
                ]
                owners = [part.column(c).take(pa.array(row)).cast(arrow.field(c).type) for c in OWNER]
                numbers = [place - begins, left, right, digest, np.array(context, np.uint64).view(np.int64)]
                yield pa.RecordBatch.from_arrays([*owners, *[pa.array(x, f.type) for x, f in zip(numbers, list(arrow)[2:], strict=True)]], schema=arrow)

    return texts.select(*OWNER, "text").mapInArrow(run, schema)


def context_strings(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The bytes of the contexts in ``wanted(key, text_hash, anchor, context, pos, left, right, alone)``."""
    fields = ["anchor", "context", "pos", "left", "right", "alone"]
    lists = wanted.groupBy(*OWNER).agg(F.collect_list(F.struct(*fields)).alias("places"))
    joined = null_safe_join(texts, lists, OWNER)
    schema = StructType([*[wanted.schema[c] for c in [*OWNER, *fields]], StructField("string", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                # One text at a time, its places as arrays: a monotonous text has very many of them.
                raw = batch.column("text")[row].as_py().encode("utf-8", "replace")
                places = batch.column("places")[row].values
                for at in range(0, len(places), 1024):
                    part = places.slice(at, 1024)
                    found = dict(zip(fields, part.flatten(), strict=True))
                    start = np.asarray(found["pos"]) - np.asarray(found["left"])
                    stop = np.asarray(found["pos"]) + np.asarray(found["right"])
                    strings = [raw[x:y] for x, y in zip(start.tolist(), stop.tolist(), strict=True)]
                    owner = [batch.column(c).take(pa.array([row] * len(part), pa.int32())) for c in OWNER]
                    columns = [*owner, *found.values(), pa.array(strings, pa.binary())]
                    yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return joined.select(*OWNER, "text", "places").mapInArrow(run, schema)


def compared(strings: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Spans ``key, text_hash, start, stop`` of the contexts that are alone, by the column-wise order.

    Strings of a ``group`` are compared, at the windows that start ``low`` to
    ``high`` bytes before the anchor.
    """
    schema = StructType([*[strings.schema[c] for c in OWNER], *SPAN])
    arrow = to_arrow_schema(schema)
    columns = [*OWNER, "group", "alone", "pos", "left", "string", "low", "high"]

    def spans(rows: list[tuple]) -> pa.RecordBatch | None:
        group = np.unique([r[2] for r in rows], return_inverse=True)[1]
        by_group = np.argsort(group, kind="stable")
        rows = [rows[i] for i in by_group]
        lefts = np.array([r[5] for r in rows])
        found = repeated_windows([r[6] for r in rows], lefts, group[by_group], length, gram)
        out = []
        for (key, digest, _, alone, pos, left, string, low, high), row in zip(rows, found, strict=True):
            if alone and row.any():
                start = pos - (length - gram)
                row[: length - gram - high] = False
                row[length - gram - low + 1 :] = False
                row[: length - gram - left] = False
                row[max(0, length - gram - left + len(string) - length + 1) :] = False  # the last window ends with the string
                out += [(key, digest, start + a, start + b + length) for a, b in runs(row)]
        return _rows(arrow, list(zip(*out, strict=True))) if out else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(values(batch, c) for c in columns), strict=True):
                if len(held) >= ROUND_STRINGS and row[2] != held[-1][2]:
                    if (done := spans(held)) is not None:
                        yield done
                    held = []
                held.append(row)
        if held and (done := spans(held)) is not None:
            yield done

    dealt = strings.repartition("group").sortWithinPartitions("group")
    return dealt.select(*columns).mapInArrow(run, schema)


def ranges(low: int, high: int) -> list[tuple[int, int]]:
    """Up to ``PARTS`` ranges of offsets that make up the range from ``low`` to ``high``."""
    size = -(-(high - low + 1) // PARTS)
    return [(a, min(high, a + size - 1)) for a in range(low, high + 1, size)]


def split_crowds(strings: DataFrame, current: DataFrame, length: int = LENGTH) -> DataFrame:
    """``current(anchor, context, low, high)`` to the same for parts of the range, with a ``group`` and a ``whole``.

    Windows that start ``low`` to ``high`` bytes before the anchor have a core
    in common; only contexts with the same core, the group, can share one.
    Contexts with the same ``whole`` have the same windows in the range.
    """
    schema = StructType([StructField("group", LongType()), StructField("whole", LongType()), *HASHES, *RANGE])
    arrow = to_arrow_schema(schema)
    columns = ["anchor", "context", "left", "string", "low", "high"]

    def hashed(data: bytes, seed: int) -> int:
        value = xxhash.xxh64_intdigest(data, seed)
        return value - (1 << 64) if value >> 63 else value

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "string", PIECE):
                rows = []
                for anchor, context, left, string, low, high in zip(*(values(part, c) for c in columns), strict=True):
                    right = len(string) - left
                    for a, b in ranges(low, high):
                        if left >= a and right >= length - b:
                            core = hashed(string[left - a : left + length - b], (a << 16) | b)
                            first, last = min(left, b), min(right, length - a)
                            whole = hashed(string[left - first : left + last], (a << 48) | (b << 32) | (first << 16) | last)
                            rows.append((core, whole, anchor, context, a, b))
                if rows:
                    yield _rows(arrow, list(zip(*rows, strict=True)))

    joined = strings.join(current, ["anchor", "context"])
    return joined.select(*columns).mapInArrow(run, schema)


def crowded_groups(strings: DataFrame, crowd: int, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Contexts of crowded anchors as groups of at most ``crowd``, and ranges of windows that repeat.

    Contexts that have all windows of a range in common are one from there on,
    and those windows repeat. Ranges of the others are split until a group is
    small enough; a range of one window leaves none. Only hashes are moved on
    the way, and what a round has read is deleted when the next one has it.
    """
    current = strings.select("anchor", "context", F.lit(0).alias("low"), F.lit(length - gram).alias("high"))
    few, windows = [], []
    while True:
        parts = cut_lineage(split_crowds(strings, current, length), "parts")
        place = F.struct("anchor", "context", "low", "high")
        folded = cut_lineage(parts.groupBy("group", "whole").agg(F.count("*").alias("m"), F.min(place).alias("one")), "folded")
        sizes = cut_lineage(folded.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1"), "part-sizes")
        alike = parts.join(folded.filter("m > 1").select("group", "whole"), ["group", "whole"])
        windows.append(cut_lineage(alike.select("anchor", "context", "low", "high"), "alike"))
        left = cut_lineage(folded.join(sizes, "group").select("group", "m", "n", "one.*"), "left")
        drop_scratch(parts, folded, sizes)
        few.append(left.filter(F.col("n") <= crowd).select("group", "anchor", "context", "low", "high", (F.col("m") == 1).alias("single")))
        current = left.filter(F.col("n") > crowd).select("anchor", "context", "low", "high")
        if current.isEmpty():
            return reduce(DataFrame.unionByName, few), reduce(DataFrame.unionByName, windows)


def repeated_spans(docs: DataFrame, key: str = "doc_id", column: str = "text", length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """``key, text_hash, start, stop``: spans of bytes to remove; they overlap and may repeat."""
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(column).alias("text_hash"), F.col(column).alias("text"))
    texts = texts.filter(F.octet_length("text") >= length)
    found = cut_lineage(anchor_rows(texts, length, gram), "anchors")
    groups = found.groupBy("anchor").agg(F.count("*").alias("n"), (F.min("context") != F.max("context")).alias("differ")).filter("n > 1")
    groups = cut_lineage(groups.drop("n"), "repeated")
    places = cut_lineage(found.join(groups, "anchor"), "places")
    drop_scratch(found, groups)
    whole = [*OWNER, (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("stop")]
    long = F.col("left") + F.col("right") >= length
    alike = places.filter(~F.col("differ") & long).select(*whole)
    mixed = places.filter(F.col("differ"))
    first = F.min(F.struct(*OWNER, "pos", "left", "right")).alias("first")
    contexts = cut_lineage(mixed.groupBy("anchor", "context").agg(F.count("*").alias("n"), first), "contexts")
    again = cut_lineage(contexts.filter("n > 1").select("anchor", "context"), "copies")
    copies = mixed.join(again, ["anchor", "context"]).filter(long).select(*whole)
    sizes = cut_lineage(contexts.groupBy("anchor").agg(F.count("*").alias("n_contexts")).filter(F.col("n_contexts") > crowd), "crowds")
    wanted = contexts.select("first.*", "anchor", "context", (F.col("n") == 1).alias("alone"))
    strings = cut_lineage(context_strings(texts, wanted), "strings").dropDuplicates(["anchor", "context"])
    few = strings.join(sizes, "anchor", "left_anti").withColumns({"group": F.col("anchor"), "low": F.lit(0), "high": F.lit(length - gram)})
    found = alike.unionByName(copies)
    if not sizes.isEmpty():
        crowded = cut_lineage(strings.join(sizes.select("anchor"), "anchor", "left_semi"), "crowded")
        groups, windows = crowded_groups(crowded, crowd, length, gram)
        shared = crowded.join(groups, ["anchor", "context"])
        few = few.unionByName(shared.withColumn("alone", F.col("alone") & F.col("single")).drop("single"))
        right = F.octet_length("string") - F.col("left")
        start = F.col("pos") - F.least("high", "left")
        stop = F.col("pos") - F.greatest(F.col("low"), length - right) + length
        ranged = crowded.filter("alone").join(windows, ["anchor", "context"])
        found = found.unionByName(ranged.select(*OWNER, start.cast("int").alias("start"), stop.cast("int").alias("stop")))
    return found.unionByName(compared(few, length, gram))


def remove_repeated(docs: DataFrame, key: str = "doc_id", column: str = "text", length: int = LENGTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """All columns but ``column``, with ``n_bytes``, the removed ``spans`` and the ``kept`` bytes of each text.

    ``kept`` is binary, since a cut can go through a letter.
    """
    ship_package(docs.sparkSession)
    spans = repeated_spans(docs, key, column, length, gram, crowd).distinct()
    lists = spans.groupBy(*OWNER).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    number, digest, gone = (free_name(docs.columns, c) for c in ("key", "text_hash", "spans"))
    keyed = docs.withColumn(number, F.col(key)).withColumn(digest, F.xxhash64(column))
    lists = cut_lineage(lists, "spans").withColumnsRenamed({"key": number, "text_hash": digest, "spans": gone})
    joined = null_safe_join(keyed, lists, [number, digest], "left").drop(number, digest)
    rest = [f for f in docs.schema.fields if f.name.lower() not in (column.lower(), "n_bytes", "spans", "kept")]
    span_type = ArrayType(StructType(SPAN))
    schema = StructType([*rest, StructField("n_bytes", LongType()), StructField("spans", span_type), StructField("kept", BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                sizes, cut, kept = [], [], []
                for text, found in zip(values(part, column), values(part, gone), strict=True):
                    raw = (text or "").encode("utf-8", "replace")
                    away = merged([(s["start"], s["stop"]) for s in found or []])
                    starts = [0, *[b for _, b in away]]
                    sizes.append(len(raw))
                    cut.append([{"start": a, "stop": b} for a, b in away])
                    kept.append(b"".join(raw[a:b] for a, b in zip(starts, [*[a for a, _ in away], len(raw)], strict=True)))
                new = [pa.array(c, arrow.field(n).type) for c, n in ((sizes, "n_bytes"), (cut, "spans"), (kept, "kept"))]
                old = [part.column(f.name).cast(arrow.field(f.name).type) for f in rest]
                yield pa.RecordBatch.from_arrays([*old, *new], schema=arrow)

    return joined.mapInArrow(run, schema)
