"""Near copies by SimHash.

A fingerprint has a bit for each of the 64 bits of a shingle's hash: 1 if it is
set in over half of the shingles. Two fingerprints link if at most two bits
differ. Two bits spoil at most two of ``BLOCKS`` blocks, so a close pair agrees
in three of five: each fingerprint is entered under every choice of three
blocks, entries with the same blocks are joined, and the distance is verified.

Equal fingerprints are one row from the start. A block shared by many different
fingerprints is not joined with itself, since its pairs would grow with the
square: its members are entered under all values one bit away from them and
under themselves instead. Two values are at most two bits apart exactly if they
share such an entry, and an entry has at most 65 different members, so the work
stays in proportion. Both ways lose no link.

A long text is read in pieces and its bits are summed up, so it needs little
more memory than its own size. Null and empty texts have the fingerprint 0; an
empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.llm.batches import CHUNK_BYTES, chunks, extended, free_name, pieces, values
from pagemill.llm.components import components
from pagemill.operators.ordering import null_safe_join
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

BITS = 64
BLOCKS = 5
MAX_BITS = 2
SHINGLE = 3
SEED = 42
HASHES = 1 << 17  # whose bits are counted together
ASCII_BLANK = re.compile(r"[\x20\x09-\x0D]")
CROWD = 64  # members of a block beyond which it isn't joined with itself


def shingle_hashes(text: str | None, shingle: int = SHINGLE, size: int = CHUNK_BYTES) -> Iterator[list[int]]:
    """XXH64 of every run of ``shingle`` words, repeats included; of all words if there are fewer.

    The hashes come in lists, one for each piece of about ``size`` letters.
    """
    digest = xxhash.xxh64_intdigest
    held: list[bytes] = []
    several = False
    for part in pieces(text or "", size, ASCII_BLANK):
        words = held + part.encode("utf-8", "replace").lower().split()  # of bytes: A-Z only, and ASCII white space
        held = words[max(0, len(words) - shingle + 1) :]
        if len(words) < shingle:
            held = words
            continue
        several = True
        joined = b" ".join(words)
        stops = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.r_[0, stops[:-1] + 1]
        last = len(words) - shingle + 1
        yield [digest(joined[a:b], SEED) for a, b in zip(starts[:last].tolist(), stops[shingle - 1 :].tolist(), strict=True)]
    if held and not several:
        yield [digest(b" ".join(held), SEED)]


def simhash(texts: list[str | None], shingle: int = SHINGLE, size: int = CHUNK_BYTES) -> np.ndarray:
    """The fingerprint of every text, as signed 64-bit integers; of no words it is 0."""
    ones, counts = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    owners: list[int] = []
    lists: list[list[int]] = []

    def add() -> None:
        sizes = np.array([len(h) for h in lists], np.int64)
        flat = np.fromiter(chain.from_iterable(lists), np.uint64, int(sizes.sum()))
        bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add.at(ones, owners, np.add.reduceat(bits, np.cumsum(sizes) - sizes, axis=0, dtype=np.int32))
        np.add.at(counts, owners, sizes)
        owners.clear()
        lists.clear()

    held = 0
    for i, text in enumerate(texts):
        for hashes in shingle_hashes(text, shingle, size):
            owners.append(i)
            lists.append(hashes)
            held += len(hashes)
            if held >= HASHES:
                add()
                held = 0
    if lists:
        add()
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0].view(np.int64)


def fingerprints(df: DataFrame, column: str = "text", name: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """Replace ``column`` by its fingerprint ``name``, a long. A null text counts as empty: 0."""
    ship_package(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name.lower() not in (name.lower(), column.lower())]
    schema = T.StructType([*kept, T.StructField(name, T.LongType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, column):
                yield extended(part, arrow, {name: pa.array(simhash(values(part, column), shingle), pa.int64())})

    return df.mapInArrow(run, schema)


def block_masks(bits: int = MAX_BITS, blocks: int = BLOCKS) -> list[int]:
    """Masks of every choice of ``blocks - bits`` blocks, as signed 64-bit integers."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [sum(choice) for choice in combinations(parts, blocks - bits)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(prints: DataFrame, name: str = "fingerprint", bits: int = MAX_BITS, crowd: int = CROWD) -> DataFrame:
    """Edges ``a, b`` over different fingerprints whose components are those of all pairs at most ``bits`` apart.

    ``prints`` has each fingerprint once. ``bits`` is 1 or 2.
    """
    if bits not in (1, 2):
        raise ValueError("bits must be 1 or 2")
    masks = block_masks(bits)
    value = F.col(name)
    entry = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), value.bitwiseAND(F.lit(m)).alias("k")) for i, m in enumerate(masks)]))
    entries = prints.select(value.alias("f"), entry.alias("block")).select("f", "block.i", "block.k")
    sizes = entries.groupBy("i", "k").agg(F.count("*").alias("n")).filter("n > 1")
    shared = cut_lineage(entries.join(sizes, ["i", "k"]), "blocks")
    few = shared.filter(F.col("n") <= crowd)
    left, right = few.select("i", "k", F.col("f").alias("a")), few.select("i", "k", F.col("f").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    joined = left.join(right, ["i", "k"]).filter((F.col("a") < F.col("b")) & close).select("a", "b")
    many = shared.filter(F.col("n") > crowd).select("f").distinct()
    flipped = F.array(F.col("f"), *[F.col("f").bitwiseXOR(F.lit(s)) for s in _single_bits()])
    beside = many.select("f", F.explode(flipped).alias("near"))
    if bits == 2:
        around = beside.select("f", F.min("f").over(Window.partitionBy("near")).alias("b"))
    else:
        around = beside.join(many.select(F.col("f").alias("near")), "near", "left_semi").select("f", F.col("near").alias("b"))
    around = around.filter(F.col("f") != F.col("b")).select(F.col("f").alias("a"), "b")
    return joined.unionByName(around)


def _single_bits() -> list[int]:
    return [1 << i if i < BITS - 1 else -(1 << i) for i in range(BITS)]


OWNER = ["last", "key", "text_hash"]  # the order in a group; ``last`` is true for a null key


def groups(docs: DataFrame, key: str, column: str, shingle: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """``last, key, text_hash, fingerprint`` of every row, and ``fingerprint, first``, the first row of its group."""
    plain = docs.select(F.col(key).isNull().alias("last"), F.col(key).alias("key"), F.xxhash64(column).alias("text_hash"), F.col(column).alias("text"))
    rows = cut_lineage(fingerprints(plain, "text", shingle=shingle), "fingerprints")
    prints = cut_lineage(rows.groupBy("fingerprint").agg(F.min(F.struct(*OWNER)).alias("first")), "prints")
    roots = components(links(prints.select("fingerprint"), bits=bits)).withColumnRenamed("node", "fingerprint")
    rooted = prints.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    rooted = cut_lineage(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("first").alias("first"))
    return rows, rooted.drop("first").join(least, "root").select("fingerprint", "first")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", column: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS
) -> DataFrame:
    """``key, fingerprint, component_id`` for every row of ``docs``.

    ``component_id`` is the least key reachable over links, a row's own
    included. Rows with equal fingerprints link, rows without words among them.
    Null keys take part but are never the least one, unless all are null. A key
    that occurs twice is two rows. Other columns are left out.
    """
    rows, named = groups(docs, key, column, shingle, bits)
    return rows.join(named, "fingerprint").select(F.col("key").alias(key), "fingerprint", F.col("first.key").alias("component_id"))


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", column: str = "text", shingle: int = SHINGLE, bits: int = MAX_BITS
) -> DataFrame:
    """The first document of every group, with all columns: the one with the least key, then the least hash of its text.

    Of rows that share key and text one stays.
    """
    rows, named = groups(docs, key, column, shingle, bits)
    firsts = cut_lineage(named.select("first.*").distinct(), "firsts")
    number, digest = (free_name(docs.columns, c) for c in ("key", "text_hash"))
    keyed = docs.withColumn(number, F.col(key)).withColumn(digest, F.xxhash64(column))
    wanted = firsts.select(F.col("key").alias(number), F.col("text_hash").alias(digest))
    kept = null_safe_join(keyed, wanted, [number, digest], "left_semi")
    if null_safe_join(rows.select("key", "text_hash"), firsts.drop("last"), ["key", "text_hash"], "left_semi").count() > firsts.count():
        kept = kept.dropDuplicates([number, digest])
    return kept.drop(number, digest).select(*docs.columns)
