"""Large JSON lists, such as capture files, read in many tasks.

Spark's text reader splits a file at the marks ``{``, so what a task reads is
a part of the file that begins at such a mark. Whether the part begins inside
a string, and how deep, depends on all before it; so a first pass tells for
both cases what the part does to them, one row a part, and these are chained
file by file. The second pass cuts each part at the commas of the outermost
list. An element that lies in several parts is put together again.

What is kept of a part, some hundred bytes for up to
``spark.sql.files.maxPartitionBytes`` of text, is broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.functions import variants
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

MARK = "{"
CHUNK_CHARS = 1 << 20
JSON_BLANKS = " \t\r\n"

CLOSED = re.compile(r'"(?:[^"\\]++|\\.)*+"', re.DOTALL)
REST = re.compile(r'(?:[^"\\]++|\\.)*+(")?', re.DOTALL)
TOKEN = re.compile(r'"(?:[^"\\]++|\\.)*+(")?|[\[\]{},]', re.DOTALL)


def _schema(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


PLACE = {"file": T.StringType(), "start": T.LongType()}
STATES = {f"{way}_{what}": kind for way in ("out", "in") for what, kind in (("inside", T.BooleanType()), ("depth", T.LongType()))}
PART = _schema(**PLACE, listed=T.BooleanType(), **STATES)
ENTRY = _schema(**PLACE, listed=T.BooleanType(), inside=T.BooleanType(), depth=T.LongType())
FIELD = _schema(**PLACE, number=T.LongType(), ended=T.BooleanType(), outer=T.BooleanType(), text=T.StringType())


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bool, str]]:
    """The text of each part in chunks: the part's columns, whether the chunk is its first, the chunk."""
    row, held, size, first = None, [], 0, True
    for batch in batches:
        names = [n for n in batch.schema.names if n != "value"]
        for text, *place in zip(*(batch.column(n).to_pylist() for n in ("value", *names)), strict=True):
            new = dict(zip(names, place, strict=True))
            if new != row or size >= CHUNK_CHARS:
                if held:
                    yield row, first, "".join(held)
                first, held, size = new != row, [], 0
            whole = text if new["start"] == 0 and new != row else MARK + text
            row = new
            held.append(whole)
            size += len(whole)
    if held:
        yield row, first, "".join(held)


def passed(text: str, inside: bool) -> tuple[bool, int]:
    """Whether the text ends in a string, and how much deeper; it does not end in half an escape."""
    if inside:
        rest = REST.match(text)
        if not rest.group(1):
            return True, 0
        text = text[rest.end() :]
    bare = CLOSED.sub("", text)
    cut = bare.find('"')
    bare = bare if cut < 0 else bare[:cut]
    return cut >= 0, bare.count("[") + bare.count("{") - bare.count("]") - bare.count("}")


def fields(chunks: Iterator[str], listed: bool, inside: bool, depth: int) -> Iterator[tuple[bool, bool, str]]:
    """What stands between the cuts of a part: whether it has ended there, whether it is outside the list, its text."""
    held: list[str] = []
    for text in chunks:
        at, begin = 0, 0
        if inside:
            rest = REST.match(text)
            inside, begin = not rest.group(1), rest.end()
        for token in TOKEN.finditer(text, begin) if not inside else ():
            kind = token.group()[0]
            if kind == '"':
                inside = token.group(1) is None
                continue
            before = depth
            depth += (kind in "[{") - (kind in "]}")
            if listed and ((kind == "[" and before == 0) or (kind == "," and before == 1) or (kind == "]" and depth == 0)):
                yield True, before == 0, "".join([*held, text[at : token.start()]])
                held, at = [], token.end()
        held.append(text[at:])
    yield False, listed and depth == 0, "".join(held)


def list_elements(spark: SparkSession, path: str) -> DataFrame:
    """``file, item_no, value``: the elements of the JSON list in each file as variants, numbered from 0.

    A file with a single value has that as its only element. A file that is no
    JSON as a whole gives no rows, wherever the fault is; nor does an empty list.
    """
    ship_package(spark)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.option("lineSep", MARK).text(path).select("value", *place)
    schema = to_arrow_schema(PART)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, listed, states = None, None, []

        def out() -> pa.RecordBatch:
            flat = [row["file"], row["start"], bool(listed), *states[0], *states[1]]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(flat, schema, strict=True)], schema=schema)

        for new, first, text in _parts(batches):
            if first:
                if row is not None:
                    yield out()
                row, listed, states = new, None, [(False, 0), (True, 0)]
            if listed is None and row["start"] == 0 and text.strip(JSON_BLANKS):
                listed = text.lstrip(JSON_BLANKS).startswith("[")
            after = [passed(text, inside) for inside, _ in states]
            states = [(inside, depth + more) for (inside, more), (_, depth) in zip(after, states, strict=True)]
        if row is not None:
            yield out()

    def chain(rows: pd.DataFrame) -> pd.DataFrame:
        rows, found, inside, depth = rows.sort_values("start"), [], False, 0
        listed = bool(rows["listed"].iloc[0])
        for part in rows.itertuples():
            found.append((part.file, part.start, listed, inside, depth))
            inside, depth = (part.in_inside, depth + part.in_depth) if inside else (part.out_inside, depth + part.out_depth)
        return pd.DataFrame(found, columns=ENTRY.fieldNames())

    described = cut_lineage(lines.mapInArrow(describe, PART), "parts")
    entries = cut_lineage(described.groupBy("file").applyInPandas(chain, ENTRY), "part-entries")
    cut_schema = to_arrow_schema(FIELD)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = _parts(batches)
        following = next(waiting, None)
        while following is not None:
            row, _, text = following
            chunks, following = _until_next(waiting, text)
            number, held, size = 0, [], 0
            for ended, outer, field in fields(chunks, row["listed"], row["inside"], row["depth"]):
                held.append((row["file"], row["start"], number, ended, outer, field))
                number, size = number + ended, size + len(field)
                if size >= CHUNK_CHARS:
                    yield _batch(held, cut_schema)
                    held, size = [], 0
            if held:
                yield _batch(held, cut_schema)
            following = following[0] if following else None

    # The broadcast join leaves the rows of a part where they are and in order.
    found = lines.join(F.broadcast(entries), ["file", "start"]).select("value", "file", "start", "listed", "inside", "depth")
    found = cut_lineage(found.mapInArrow(cut, FIELD), "fields")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.groupBy("file", "start").agg(F.count_if("ended").alias("_ends"))
    offsets = ends.select("file", "start", F.coalesce(F.sum("_ends").over(earlier), F.lit(0)).alias("_offset"))
    placed = found.join(offsets, ["file", "start"]).withColumn("no", F.col("_offset") + F.col("number"))
    alone = F.col("ended") & ((F.col("start") == 0) | (F.col("number") > 0))
    ordered = F.sort_array(F.collect_list(F.struct("start", "text")))
    pieces = placed.filter(~alone).groupBy("file", "no").agg(F.max("outer").alias("outer"), F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("text"))
    whole = placed.filter(alone).select("file", "no", "outer", "text").unionByName(pieces)
    blank = (F.btrim("text", F.lit(JSON_BLANKS)) == "").alias("blank")
    parsed = cut_lineage(whole.select("file", "no", "outer", blank, variants.parse(F.col("text")).alias("value")), "elements")
    checked = parsed.groupBy("file").agg(
        F.count_if("outer").alias("outers"),
        F.count_if(~F.col("outer")).alias("elements"),
        F.count_if(~F.col("outer") & F.col("blank")).alias("blanks"),
        F.count_if(~F.col("blank") & (F.col("outer") | F.col("value").isNull())).alias("faults"),
    )
    # A list has one place before it and one after it; only as the one element of an empty list may an element be blank.
    sound = checked.filter("outers IN (0, 2) AND faults = 0 AND (blanks = 0 OR elements = 1)").select("file")
    kept = parsed.filter(~F.col("outer") & ~F.col("blank")).join(sound, "file", "left_semi")
    return kept.select("file", F.greatest(F.col("no") - 1, F.lit(0)).alias("item_no"), "value")


def _until_next(waiting: Iterator, text: str) -> tuple[Iterator[str], list]:
    """The chunks of a part, and a list that holds the first chunk of the next part when they have been read."""
    following: list = []

    def chunks() -> Iterator[str]:
        yield text
        for row, first, more in waiting:
            if first:
                following.append((row, first, more))
                return
            yield more

    return chunks(), following


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
