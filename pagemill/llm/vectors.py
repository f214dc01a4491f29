"""Exact top-k search by inner product with a pivot-distance index.

With one more component, the root of what its squared length lacks to that of
the longest vector, every vector gets the same length, and the larger an inner
product with a query the smaller the distance. So the index can work on
distances: a vector's key is its nearest pivot and the distance to it. The keys
of a pivot are cut into annuli. By the triangle inequality an annulus can't
hold anything nearer to a query than the gap between the query's own distance
to the pivot and the annulus.

A query first visits the annuli with the smallest gaps until they hold enough
vectors; the last of its best scores is its bound. Then it visits, of all
others, those that can still reach the bound. Vectors and queries travel in
packed blocks, joined on the annulus, and a block's scores are one matrix
product of whole numbers below 2^53, so they are exact.

Pivots and cuts come from a sample of at most ``SAMPLE`` vectors; every vector
is indexed. Equal vectors are one entry with its smallest ids, as many as a
result can need: a vector that a third of all rows share costs no more than
another. Vectors that are null, empty or hold a null or a value that is not
finite take no part; a shorter vector counts as filled up with zeros. Rows with
a null id take no part. An id that occurs twice is one candidate for each of
its vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from pagemill.llm.batches import values
from pagemill.operators.ordering import top_per_key
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

SAMPLE = 4_096
PIVOTS = 48
RING_ROWS = 512  # vectors an annulus should hold, as long as there are no more than the sample can cut
BLOCK = 256  # vectors or queries in a packed block
SLACK = 1e-6  # of a bound: distances are rounded


def quantised(column: str, scale: int = 64) -> Column:
    """Whole numbers ``floor(scale * x)``; null for a vector that takes no part."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(column, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when(F.col(column).isNotNull() & (F.size(column) > 0) & ~bad, whole)


@dataclass(frozen=True)
class Index:
    """What all tasks need: pivots, cuts of each pivot's distances, and the squared length of the longest vector."""

    width: int
    longest: float
    pivots: np.ndarray
    cuts: list[np.ndarray]
    offsets: np.ndarray

    def matrix(self, vectors: list[list[int]]) -> np.ndarray:
        flat = np.zeros((len(vectors), self.width))
        for row, vector in zip(flat, vectors, strict=True):
            row[: len(vector)] = vector
        return flat

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        missing = np.sqrt(np.maximum(self.longest - (vectors**2).sum(1), 0))
        return np.column_stack([vectors, missing])

    def to_pivots(self, points: np.ndarray) -> np.ndarray:
        squared = (points**2).sum(1)[:, None] + (self.pivots**2).sum(1) - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(squared, 0))

    def keys(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The annulus of every vector and its distance to the pivot."""
        distance = self.to_pivots(self.lifted(vectors))
        nearest = distance.argmin(1)
        own = distance[np.arange(len(vectors)), nearest]
        ring = np.array([np.searchsorted(self.cuts[p], d, side="right") for p, d in zip(nearest, own, strict=True)], int)
        return self.offsets[nearest] + ring, own


def fit_index(distinct: DataFrame) -> Index | None:
    """Pivots and cuts from a bounded sample of ``distinct(vid, q)``; none for an empty table."""
    square = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    total, width, longest = distinct.agg(F.count("*"), F.max(F.size("q")), F.max(square)).first()
    if not total:
        return None
    # The lowest hashes. Only about twice as many are looked at, or every task would send the driver as many as are wanted.
    spot, share = F.xxhash64("vid"), 2 * SAMPLE / total
    low = distinct.filter(spot < int(share * 2**64) - 2**63) if share < 1 else distinct
    rows = low.orderBy(spot, "vid").limit(SAMPLE).select("q").collect()
    index = Index(width, float(longest), np.zeros((0, width + 1)), [], np.zeros(0, int))
    points = index.lifted(index.matrix([r["q"] for r in rows]))
    chosen, gap = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(PIVOTS, len(points)) and gap.max() > 0:  # each pivot is the point farthest from the others
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((points - points[chosen[-1]]) ** 2).sum(1))
    index = Index(width, float(longest), points[chosen], [], np.zeros(0, int))
    distance = index.to_pivots(points)
    nearest = distance.argmin(1)
    rings, cuts = min(math.ceil(total / RING_ROWS), SAMPLE), []
    for p in range(len(chosen)):
        own = np.sort(distance[nearest == p, p])
        count = max(1, round(rings * len(own) / len(points)))
        cuts.append(np.unique(own[[len(own) * i // count for i in range(1, count)]]) if count > 1 else np.zeros(0))
    return Index(width, float(longest), index.pivots, cuts, np.cumsum([0, *[len(c) + 1 for c in cuts[:-1]]]))


ENTRIES = StructType([StructField("vid", StringType()), StructField("low_id", LongType()), StructField("ring", IntegerType()), StructField("distance", DoubleType()), StructField("q", ArrayType(LongType()))])
BLOCKS = StructType([StructField("ring", IntegerType()), StructField("vids", ArrayType(StringType())), StructField("ids", BinaryType()), StructField("data", BinaryType())])
VISITS = StructType([StructField("ring", IntegerType()), StructField("qids", ArrayType(StringType())), StructField("bounds", BinaryType()), StructField("queries", BinaryType())])
FOUND = StructType([StructField("qid", StringType()), StructField("score", LongType()), StructField("vid", StringType()), StructField("low_id", LongType())])


def _rows(schema: StructType, columns: list) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)


def keyed(distinct: DataFrame, index: Index) -> DataFrame:
    """Every vector with its annulus."""
    shared = distinct.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = values(batch, "q")
                rings, own = shared.value.keys(shared.value.matrix(vectors))
                yield _rows(ENTRIES, [values(batch, "vid"), values(batch, "low_id"), rings, own, vectors])

    return distinct.select("vid", "low_id", "q").mapInArrow(run, ENTRIES)


def vector_blocks(entries: DataFrame, index: Index) -> DataFrame:
    """Vectors of one annulus, at most ``BLOCK`` a row; a large annulus gets many rows, in many tasks."""
    shared = entries.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings = np.array(values(batch, "ring"), int)
            starts = np.flatnonzero(np.diff(rings, prepend=-1))
            for a, b in zip(starts, [*starts[1:], len(rings)], strict=True):
                for at in range(a, b, BLOCK):
                    part = batch.slice(at, min(BLOCK, b - at))
                    data = shared.value.matrix(values(part, "q")).astype("<i8").tobytes()
                    ids = np.array(values(part, "low_id"), "<i8").tobytes()
                    yield _rows(BLOCKS, [[int(rings[a])], [values(part, "vid")], [ids], [data]])

    spread = entries.repartitionByRange("ring", "vid").sortWithinPartitions("ring", "vid")
    return spread.select("ring", "vid", "low_id", "q").mapInArrow(run, BLOCKS)


def visits(queries: DataFrame, index: Index, rings: list[tuple[int, float, float, int]], need: int, first: bool) -> DataFrame:
    """Blocks of queries with an annulus that some of them have to visit.

    ``rings`` has number, least and greatest distance and size of every
    annulus. ``queries(vid, q, bound)``: the bound is null before the first
    visit. A block's ``bounds`` are the scores that count, infinite for a query
    that needn't come.
    """
    shared = queries.sparkSession.sparkContext.broadcast((index, np.array(rings, float).reshape(-1, 4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table = shared.value
        number, low, high, size = table.T
        pivot = np.searchsorted(held.offsets, number, side="right") - 1
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                vectors = held.matrix(values(part, "q"))
                distance = held.to_pivots(np.column_stack([vectors, np.zeros(len(vectors))]))[:, pivot]
                gap = np.maximum(np.maximum(distance - high, low - distance), 0)
                order = np.argsort(gap, axis=1, kind="stable")
                before = np.cumsum(size[order], axis=1) - size[order]
                early = np.zeros(gap.shape, bool)
                np.put_along_axis(early, order, before < need, axis=1)
                if first:
                    wanted, bound = early, np.full(len(vectors), -np.inf)
                else:
                    bound = np.array([-np.inf if b is None else b for b in values(part, "bound")], float)
                    best = ((vectors**2).sum(1)[:, None] + held.longest - gap**2) / 2
                    wanted = ~early & (best + SLACK * (1 + np.abs(best)) >= bound[:, None])
                ids, data = values(part, "vid"), vectors.astype("<i8")
                for r in np.flatnonzero(wanted.any(0)):
                    come = np.flatnonzero(wanted[:, r])
                    yield _rows(VISITS, [[int(number[r])], [[ids[i] for i in come]], [bound[come].tobytes()], [data[come].tobytes()]])

    return queries.select("vid", "q", "bound").mapInArrow(run, VISITS)


def scored(blocks: DataFrame, coming: DataFrame, width: int, top: int) -> DataFrame:
    """The best ``top`` vectors of every block for every query that visits it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("vids", "ids", "data", "qids", "bounds", "queries")}
                data = np.frombuffer(row["data"], "<i8").reshape(-1, width).astype(float)
                asked = np.frombuffer(row["queries"], "<i8").reshape(-1, width).astype(float)
                ids, bounds = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["bounds"], float)
                scores = np.rint(asked @ data.T)
                out: list[tuple] = []
                for q, line in enumerate(scores):
                    least = bounds[q]
                    if len(line) > top:
                        least = max(least, np.partition(line, -top)[-top])
                    at = np.flatnonzero(line >= least)
                    at = at[np.lexsort((ids[at], -line[at]))[:top]]
                    out += [(row["qids"][q], int(line[i]), row["vids"][i], int(ids[i])) for i in at]
                if out:
                    yield _rows(FOUND, list(zip(*out, strict=True)))

    # Never a broadcast: packed numbers take few bytes in a file and many times as many in memory. An annulus has fewer blocks than visits.
    met = coming.join(blocks.hint("merge"), "ring").select("vids", "ids", "data", "qids", "bounds", "queries")
    return met.mapInArrow(run, FOUND)


def top_k(vectors: DataFrame, queries: Column, k: int = 20, key: str = "vec_id", column: str = "embedding", scale: int = 64) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best other rows for every row where ``queries`` is true.

    The score is the inner product of the scaled whole numbers, ties go to the
    smaller id; all other rows if there are fewer than ``k``.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(F.col(key).cast("long").alias("id"), queries.alias("asked"), quantised(column, scale).alias("q"))
    rows = rows.filter("id IS NOT NULL AND q IS NOT NULL").withColumn("vid", F.md5(F.array_join("q", ",").cast("binary")))
    rows = cut_lineage(rows, "vectors")
    # Ids of equal vectors: the smallest, one more than a result has, since a query leaves itself out.
    members = top_per_key(rows.select("vid", "id"), ["vid"], ["id"], k + 1)
    members = cut_lineage(members.groupBy("vid").agg(F.sort_array(F.collect_list("id")).alias("ids")), "members")
    distinct = rows.groupBy("vid").agg(F.min("id").alias("low_id"), F.first("q").alias("q"), F.max("asked").alias("asked"))
    distinct = cut_lineage(distinct, "distinct")
    index = fit_index(distinct)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    entries = cut_lineage(keyed(distinct, index), "entries")
    rings = [tuple(r) for r in entries.groupBy("ring").agg(F.min("distance"), F.max("distance"), F.count("*")).orderBy("ring").collect()]
    blocks = cut_lineage(vector_blocks(entries, index), "blocks")
    asked = distinct.filter("asked").select("vid").join(entries, "vid")
    asked = asked.repartitionByRange("ring", "vid").sortWithinPartitions("ring", "vid")  # neighbours share blocks
    start = asked.select("vid", "q", F.lit(None).cast("double").alias("bound"))
    early = cut_lineage(scored(blocks, visits(start, index, rings, k + 1, True), index.width, k + 1), "early")
    best = top_per_key(early, ["qid"], [F.desc("score"), F.asc("low_id")], k + 1, "place")
    bounds = best.filter(F.col("place") == k + 1).select(F.col("qid").alias("vid"), F.col("score").cast("double").alias("bound"))
    again = asked.select("vid", "ring", "q").join(bounds, "vid", "left").repartitionByRange("ring", "vid").sortWithinPartitions("ring", "vid")
    late = scored(blocks, visits(again, index, rings, k + 1, False), index.width, k + 1)
    best = top_per_key(early.unionByName(late), ["qid"], [F.desc("score"), F.asc("low_id")], k + 1, "place").drop("place")
    candidates = best.join(members, "vid").select("qid", "score", F.explode("ids").alias("vec_id"))
    candidates = cut_lineage(top_per_key(candidates, ["qid"], [F.desc("score"), F.asc("vec_id")], k + 1, "place").drop("place"), "candidates")
    lists = candidates.groupBy("qid").agg(F.collect_list(F.struct((-F.col("score")).alias("worse"), "vec_id")).alias("found"))
    asking = rows.filter("asked").select(F.col("id").alias("query_id"), F.col("vid").alias("qid"))
    joined = asking.join(lists, "qid")
    others = F.slice(F.array_sort(F.filter("found", lambda c: c["vec_id"] != F.col("query_id"))), 1, k)
    ranked = joined.select("query_id", F.posexplode(others).alias("place", "c"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("c.vec_id").alias("vec_id"), (-F.col("c.worse")).alias("score"))
