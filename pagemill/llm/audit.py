"""What filters take from a corpus in every order: a table of removals, redundancies and losses.

A document's failures are a mask with a bit for each filter. Applied in some
order, the first filter that it fails removes it. So the removal step of a mask
in an order is a product in the min-plus algebra: the mask matrix has 0 where a
mask fails a filter and infinity elsewhere, the position matrix has a filter's
place in an order (the inverse of the permutation), and the least sum over the
filters is the step. Counts of masks, weighted by documents, are scattered to
the steps.

Each text is read once. The masks are counted by Spark, so what meets the
matrices is at most a row for each part and mask, whatever the size of the
corpus. Equal texts are found by SHA-256 and their least key, a minimum that is
taken before anything is shuffled; the rows are joined to it, and a join splits
a text that a third of the rows share.

A null text counts as empty, a null part as the empty string. A row with a null
key is never a copy and none is a copy of it; rows that share key and text are
no copies of each other, each counts as a document. A key with several labels
has a label if one of them has it. Other columns are ignored. An empty table
gives no rows. Texts are cut at white space before their words are counted, so
a long text needs the memory of its different words, not of all.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.llm.batches import chunks
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

PIECE_BYTES = 1 << 20
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUING = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
MARKS = b"#$%&*|"
SPACE = re.compile(rb"[\x20\x09-\x0D]")


class TextFacts(NamedTuple):
    words: int
    distinct: int
    capitals: int
    points: int
    marked: bool


def text_facts(raw: bytes, piece: int = PIECE_BYTES) -> TextFacts:
    """Words are runs of anything but ASCII white space; ``raw`` is UTF-8."""
    words, seen, at = 0, set(), 0
    while at < len(raw):
        cut = SPACE.search(raw, at + piece) if at + piece < len(raw) else None
        end = cut.start() if cut else len(raw)
        found = raw[at:end].split()
        words += len(found)
        seen.update(found)
        at = end
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    marked = len(raw.translate(None, MARKS)) < len(raw)
    return TextFacts(words, len(seen), capitals, len(raw.translate(None, CONTINUING)), marked)


# Name of a filter and when a text fails it. A copy of an earlier row's text fails ``COPY``.
FILTERS: dict[str, Callable[[TextFacts], bool]] = {
    "A": lambda t: t.words < 200,
    "B": lambda t: 100 * t.distinct < 50 * t.words,
    "C": lambda t: 100 * t.capitals > 3 * t.points,
    "D": lambda t: t.marked,
}
COPY = "E"


def failures(docs: DataFrame, filters: dict[str, Callable[[TextFacts], bool]], key: str, column: str, part: str) -> DataFrame:
    """``key, part, mask, digest`` of every row; bit ``i`` of the mask is set if the text fails filter ``i``."""
    ship_package(docs.sparkSession)
    schema = T.StructType([
        T.StructField("key", docs.schema[key].dataType),
        T.StructField("part", T.StringType()),
        T.StructField("mask", T.IntegerType()),
        T.StructField("digest", T.BinaryType()),
    ])
    arrow = to_arrow_schema(schema)
    tests = list(filters.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in chunks(batch, "raw"):
                masks, digests = [], []
                for value in some.column("raw"):
                    raw = value.as_py()
                    facts = text_facts(raw)
                    masks.append(sum(1 << i for i, fails in enumerate(tests) if fails(facts)))
                    digests.append(hashlib.sha256(raw).digest())
                arrays = [some.column("key").cast(arrow[0].type), some.column("part").cast(arrow[1].type), pa.array(masks, pa.int32()), pa.array(digests, arrow[3].type)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    raw = F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")
    plain = docs.select(F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), raw.alias("raw"))
    return plain.mapInArrow(run, schema)


def with_copies(rows: DataFrame, bit: int) -> DataFrame:
    """Set ``bit`` of the mask of rows whose digest a smaller key has."""
    rows = cut_lineage(rows, "failures")
    firsts = rows.groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = rows.join(cut_lineage(firsts, "firsts"), "digest", "left")
    later = F.coalesce(F.col("key") > F.col("first"), F.lit(False))
    return joined.select("key", "part", (F.col("mask") + F.when(later, 1 << bit).otherwise(0)).alias("mask"))


def mask_counts(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """``part, mask, n, good, toxic``: documents with a mask, and how many of them have a label."""
    marks = labels.groupBy(F.col(key).alias("key")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    labelled = rows.join(marks.filter("key IS NOT NULL AND (good = 1 OR toxic = 1)"), "key", "left")
    return labelled.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")
    )


def min_plus(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least of ``left[i, k] + right[j, k]`` over ``k``."""
    return (left[:, None, :] + right[None, :, :]).min(axis=2)


def removal_steps(masks: np.ndarray, orders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The step at which each order removes each mask (the number of filters: never), and the position of each filter."""
    count = orders.shape[1]
    positions = np.empty(orders.shape, float)
    np.put_along_axis(positions, orders, np.arange(count, dtype=float)[None, :], axis=1)
    fails = (masks[:, None] >> np.arange(count)) & 1
    steps = min_plus(np.where(fails == 1, 0.0, np.inf), positions)
    return np.where(np.isinf(steps), count, steps).astype(int), positions.astype(int)


def interactions(counts: pd.DataFrame, names: Sequence[str]) -> pd.DataFrame:
    """One part's rows for every order and step, from its counts of masks."""
    size = len(names)
    orders = np.array(list(permutations(range(size))))
    masks = counts["mask"].to_numpy()
    steps, positions = removal_steps(masks, orders)
    rows = np.broadcast_to(np.arange(len(orders))[None, :], steps.shape)

    def scattered(weights: np.ndarray) -> np.ndarray:
        out = np.zeros((len(orders), size + 1), np.int64)
        np.add.at(out, (rows, steps), np.broadcast_to(weights[:, None], steps.shape))
        return out[:, :size]

    n = counts["n"].to_numpy()
    removed = scattered(n)
    fails = ((masks[:, None] >> np.arange(size)) & 1).astype(bool)
    redundant = np.zeros((len(orders), size), np.int64)
    for f in range(size):
        at = positions[:, f]
        late = fails[:, f, None] & (steps < at[None, :])
        redundant[np.arange(len(orders)), at] = (late * n[:, None]).sum(0)
    alone = np.array([n[masks == 1 << f].sum() for f in range(size)], np.int64)
    shapley = np.array([removed[np.arange(len(orders)), positions[:, f]].sum() for f in range(size)], np.int64)
    return pd.DataFrame({
        "part": counts["part"].iloc[0],
        "filter_order": np.repeat(["".join(names[f] for f in order) for order in orders], size),
        "step": np.tile(np.arange(1, size + 1, dtype=np.int32), len(orders)),
        "kept": (n.sum() - removed.cumsum(1)).ravel(),
        "removed": removed.ravel(),
        "redundant": redundant.ravel(),
        "unique_fails": alone[orders].ravel(),
        "good_lost": scattered(counts["good"].to_numpy()).ravel(),
        "toxic_lost": scattered(counts["toxic"].to_numpy()).ravel(),
        "shapley": shapley[orders].ravel(),
    })


AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    filters: dict[str, Callable[[TextFacts], bool]] | None = None,
    key: str = "doc_id",
    column: str = "text",
    part: str = "lang",
) -> DataFrame:
    """A row for each part, order of the filters and step; ``COPY`` is the last filter.

    ``kept`` is what is left after the step, ``removed`` what goes in it;
    ``redundant`` fails its filter but went before, ``unique_fails`` fails no
    other; ``good_lost`` and ``toxic_lost`` are removed documents with a label;
    ``shapley`` is what its filter removes, summed over all orders.
    """
    filters = FILTERS if filters is None else filters
    names = [*filters, COPY]
    rows = with_copies(failures(docs, filters, key, column, part), len(filters))
    counts = mask_counts(rows, labels, key)

    def spread(group: pd.DataFrame) -> pd.DataFrame:
        return interactions(group, names)

    return counts.groupBy("part").applyInPandas(spread, AUDIT)
