"""Near copies of vectors by an inverted multi-index.

A vector of unit length is cut into halves, each with a codebook of its own;
the pairs of codes form a grid of cells. A vector lies in the cell of its two
nearest codes. Looking for near copies, it visits the cells in the order of the
sum of its two squared distances (the multi-sequence traversal) and stops where
``target`` of all partners would have been met. Where that is, is learnt from a
bounded sample: partners exactly at the threshold, the farthest that count, in
a random direction, and the real ones in the sample.

Of two vectors in different cells the one in the lower cell visits the other, so
a pair is met once. What is met is verified by its cosine in double precision;
values within rounding of the threshold are computed again with exact sums. So
no link below the threshold is found, and of those above about ``target``.

Equal vectors are one entry from the start, with their number. A cell is
compared in blocks of about ``BLOCK`` members and visitors, so a crowded cell is
spread over as many tasks as it needs, and its pairs are counted, not written: a
block gives a number for each vector and the edges of a spanning forest.

The codebooks come from at most ``SAMPLE`` vectors, and no more than
``SAMPLE_VALUES`` numbers; every vector is indexed. Vectors of different lengths
don't link; a length that is rare in the sample has a grid of one cell.

Defined results: a vector that is null, empty, all zero or holds a null or a
value that is not finite links with nothing and is its own component. Rows with
the same id are different vectors. A row with a null id links as others do; the
component has the least id that is not null. Other columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.llm.batches import values
from pagemill.llm.components import components
from pagemill.operators.ordering import lookup_join
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

THRESHOLD = 0.95
TARGET = 0.99
SAMPLE = 8_192
SAMPLE_VALUES = 1 << 21
TRIED = 1_024  # vectors of the sample that get a partner to learn the budget from
LEAST_SAMPLE = 64  # a length with fewer vectors in the sample has one cell
CELL_ROWS = 256
VECTORS_PER_CODE = 8  # of the sample, at least; bounds a codebook
ROUNDS = 12
BLOCK = 512
NEAR = 1e-12


def squared(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    gaps = (points**2).sum(1)[:, None] + (codes**2).sum(1)[None, :] - 2 * points @ codes.T
    return np.maximum(gaps, 0.0)


def codebook(points: np.ndarray, count: int) -> np.ndarray:
    """At most ``count`` centres by Lloyd's rounds from evenly spaced points."""
    codes = np.unique(points[np.linspace(0, len(points) - 1, count).astype(int)], axis=0)
    for _ in range(ROUNDS):
        nearest = squared(points, codes).argmin(1)
        sums, sizes = np.zeros_like(codes), np.bincount(nearest, minlength=len(codes))
        np.add.at(sums, nearest, points)
        codes[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return codes


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision; rows have a value other than zero."""
    vectors = vectors.astype(float)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))


@dataclass(frozen=True)
class Grid:
    """Codebooks of the two halves, and how much farther than its own cell a vector visits."""

    half: int
    first: np.ndarray
    second: np.ndarray
    budget: float = 0.0

    def gaps(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of the halves to the codes beyond the nearest one."""
        parts = squared(points[:, : self.half], self.first), squared(points[:, self.half :], self.second)
        return parts[0] - parts[0].min(1, keepdims=True), parts[1] - parts[1].min(1, keepdims=True)

    def homes(self, points: np.ndarray) -> np.ndarray:
        first, second = self.gaps(points)
        return first.argmin(1) * len(self.second) + second.argmin(1)

    def traversal(self, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rounds of the traversal for all points at once: who still visits, and the next nearest cell of each.

        For each first code the next second code is held; the next cell is the
        least sum among them.
        """
        first, second = self.gaps(points)
        order = second.argsort(1, kind="stable")
        second = np.column_stack([np.take_along_axis(second, order, 1), np.full(len(points), np.inf)])
        at, active = np.zeros(first.shape, int), np.arange(len(points))
        while len(active):
            sums = first[active] + np.take_along_axis(second[active], at[active], 1)
            row = sums.argmin(1)
            within = sums[np.arange(len(active)), row] <= self.budget
            active, row = active[within], row[within]
            if len(active):
                yield active, row * len(self.second) + order[active, at[active, row]]
                at[active, row] += 1

    def visits(self, points: np.ndarray) -> list[list[int]]:
        """The cells above its own that each point visits, nearest first."""
        homes, found = self.homes(points), [[] for _ in points]
        for who, cells in self.traversal(points):
            for i, cell in zip(who.tolist(), cells.tolist(), strict=True):
                if cell > homes[i]:
                    found[i].append(cell)
        return found


def fit_grid(points: np.ndarray, total: int, threshold: float, target: float) -> Grid:
    """A grid for about ``total`` vectors, from unit vectors of a sample."""
    half, size = points.shape[1] // 2, len(points)
    codes = max(1, min(math.ceil(math.sqrt(total / CELL_ROWS)), size // VECTORS_PER_CODE))
    grid = Grid(half, codebook(points[:, :half], codes), codebook(points[:, half:], codes))
    tried, rng = points[:: max(1, size // TRIED)], np.random.default_rng(13)
    aside = rng.normal(size=tried.shape)
    aside -= (aside * tried).sum(1, keepdims=True) * tried
    lengths = np.sqrt((aside**2).sum(1, keepdims=True))
    aside = np.divide(aside, lengths, out=np.zeros_like(aside), where=lengths > 1e-9)
    needs = [_needed(grid, tried, threshold * tried + math.sqrt(max(0.0, 1 - threshold**2)) * aside)]
    for at in range(0, size, BLOCK):
        a, b = np.nonzero(np.triu(points[at : at + BLOCK] @ points[at:].T >= threshold, 1))
        if len(a):
            some = slice(0, None, max(1, len(a) // TRIED))
            needs.append(_needed(grid, points[at + a[some]], points[at + b[some]]))
    real = np.concatenate(needs[1:]) if len(needs) > 1 else needs[0]
    budget = max(float(np.quantile(x, target)) for x in (needs[0], real))
    return Grid(half, grid.first, grid.second, budget + 1e-9)


def _needed(grid: Grid, points: np.ndarray, partners: np.ndarray) -> np.ndarray:
    """The budget with which each point visits the cell of its partner."""
    first, second = grid.gaps(points)
    homes, rows = grid.homes(partners), np.arange(len(points))
    return first[rows, homes // len(grid.second)] + second[rows, homes % len(grid.second)]


def comparable(column: str) -> Column:
    odd = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(column).isNotNull() & ~odd & F.exists(column, lambda x: x != 0), F.lit(False))


def fit(entries: DataFrame, threshold: float, target: float) -> dict[int, Grid]:
    """A grid for every length that is frequent in the sample; ``entries`` has ``vid, v``."""
    total, width = entries.agg(F.count("*"), F.max(F.size("v"))).first()
    if not total:
        return {}
    rows = entries.orderBy("vid").limit(max(LEAST_SAMPLE, min(SAMPLE, SAMPLE_VALUES // width))).select("v").collect()
    by_width: dict[int, list] = {}
    for row in rows:
        by_width.setdefault(len(row["v"]), []).append(row["v"])
    share = total / len(rows)
    return {w: fit_grid(unit(np.array(vs, float)), round(len(vs) * share), threshold, target) for w, vs in by_width.items() if len(vs) >= LEAST_SAMPLE}


PLACED = T.StructType([
    T.StructField("vid", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("width", T.IntegerType()),
    T.StructField("cell", T.IntegerType()),
    T.StructField("visits", T.ArrayType(T.IntegerType())),
    T.StructField("v", T.BinaryType()),
])
FOUND = T.StructType([T.StructField("vid", T.StringType()), T.StructField("links", T.LongType()), T.StructField("root", T.StringType())])
BATCH = 1_024


def placed(entries: DataFrame, grids: dict[int, Grid], code: str) -> DataFrame:
    """Every entry with its cell and the cells that it visits; ``code`` is the numpy type of its values."""
    shared, arrow = entries.sparkSession.sparkContext.broadcast(grids), to_arrow_schema(PLACED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                vectors = values(part, "v")
                widths = np.array([len(v) for v in vectors])
                cells, visits = np.zeros(len(vectors), int), [[] for _ in vectors]
                for width in np.unique(widths).tolist():
                    rows = np.flatnonzero(widths == width)
                    grid = shared.value.get(width)
                    if grid is not None:
                        points = unit(np.array([vectors[i] for i in rows], float))
                        cells[rows] = grid.homes(points)
                        for i, found in zip(rows, grid.visits(points), strict=True):
                            visits[i] = found
                packed = [np.array(v, code).tobytes() for v in vectors]
                columns = [values(part, "vid"), values(part, "n"), widths, cells, visits, packed]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return entries.select("vid", "n", "v").mapInArrow(run, PLACED)


def close_pairs(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which rows of ``left`` and ``right`` have a cosine of at least ``threshold``."""
    a, b = unit(left), unit(right)
    cosines = a @ b.T
    close = cosines >= threshold
    for i, j in np.argwhere(np.abs(cosines - threshold) <= NEAR):
        x, y = left[i].astype(float), right[j].astype(float)
        x, y = x / np.abs(x).max(), y / np.abs(y).max()
        product = math.fsum(x * y)
        close[i, j] = product / math.sqrt(math.fsum(x * x) * math.fsum(y * y)) >= threshold
    return close


def forest(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows and columns of a bipartite graph the least row that they reach; the number of rows for those without an edge."""
    none = len(close)
    rows = np.where(close.any(1), np.arange(none), none)
    while True:
        columns = np.where(close, rows[:, None], none).min(0, initial=none)
        least = np.minimum(rows, np.where(close, columns[None, :], none).min(1, initial=none))
        if (least == rows).all():
            return rows, columns
        rows = least


def compared(rows: DataFrame, code: str, threshold: float) -> DataFrame:
    """``vid, links`` counts, and ``vid, root`` edges, of blocks of members and visitors."""
    arrow = to_arrow_schema(FOUND)

    def run(block: pa.Table) -> pa.Table:
        member = block.column("member").to_numpy()
        own = block.column("own").to_numpy()
        vids = np.array(block.column("vid").to_pylist(), object)
        n = block.column("n").to_numpy()
        if member.all() or not member.any():
            return arrow.empty_table()
        flat = np.frombuffer(b"".join(block.column("v").to_pylist()), code).reshape(len(vids), -1)
        close = close_pairs(flat[~member], flat[member], threshold)
        close &= vids[~member][:, None] != vids[member][None, :]
        foreign = ~own[~member]
        links = [(v, int(c), None) for v, c in zip(vids[~member], close @ n[member], strict=True) if c]
        links += [(v, int(c), None) for v, c in zip(vids[member], n[~member][foreign] @ close[foreign], strict=True) if c]
        at_rows, at_columns = forest(close)
        for names, roots in ((vids[~member], at_rows), (vids[member], at_columns)):
            links += [(v, None, vids[~member][r]) for v, r in zip(names, roots, strict=True) if r < len(close)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*links, strict=True), arrow, strict=True)], schema=arrow) if links else arrow.empty_table()

    return rows.groupBy("width", "cell", "member_block", "visit_block").applyInArrow(run, FOUND)


def blocks(index: DataFrame) -> DataFrame:
    """Members and visitors of every cell, dealt into blocks; every two blocks of a cell meet once."""
    spot = F.xxhash64("vid")
    visited = index.select("width", F.explode("visits").alias("cell")).groupBy("width", "cell").agg(F.count("*").alias("visitors"))
    held = index.groupBy("width", "cell").agg(F.count("*").alias("members"))
    sizes = held.join(visited, ["width", "cell"], "left").fillna(0, ["visitors"])
    # A cell of one vector that nobody visits has nothing to compare.
    sizes = sizes.filter("members > 1 OR visitors > 0").select(
        "width", "cell", F.ceil(F.col("members") / BLOCK).cast("int").alias("members"), F.ceil((F.col("members") + F.col("visitors")) / BLOCK).cast("int").alias("visits")
    )
    sizes = cut_lineage(sizes, "cells")
    home = index.select("width", "cell", "vid", "n", "v", F.lit(True).alias("own"))
    come = index.select("width", F.explode("visits").alias("cell"), "vid", "n", "v", F.lit(False).alias("own"))
    coming = home.unionByName(come).join(sizes, ["width", "cell"])
    block = F.pmod(spot, F.col("visits")).cast("int")
    visitors = coming.select(
        "width", "cell", F.explode(F.sequence(F.lit(0), F.col("members") - 1)).alias("member_block"), block.alias("visit_block"), F.lit(False).alias("member"), "own", "vid", "n", "v"
    )
    members = home.join(sizes, ["width", "cell"]).select(
        "width",
        "cell",
        F.pmod(spot, F.col("members")).cast("int").alias("member_block"),
        F.explode(F.sequence(F.lit(0), F.col("visits") - 1)).alias("visit_block"),
        F.lit(True).alias("member"),
        "own",
        "vid",
        "n",
        "v",
    )
    return members.unionByName(visitors)


def near_copies(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row of ``vectors``.

    ``n_links`` is the number of other rows linked directly, ``component_id`` the
    least key that is reachable; a row is kept if it has that key.
    """
    ship_package(vectors.sparkSession)
    code = "<f4" if isinstance(vectors.schema[column].dataType.elementType, T.FloatType) else "<f8"
    named = vectors.select(F.col(key).alias("id"), F.when(comparable(column), F.col(column)).alias("v"))
    named = cut_lineage(named.withColumn("vid", F.md5(F.array_join("v", ",").cast("binary"))), "vectors")
    whole = named.filter("v IS NOT NULL")
    entries = cut_lineage(whole.groupBy("vid").agg(F.min("id").alias("low"), F.count("*").alias("n"), F.first("v").alias("v")), "entries")
    index = cut_lineage(placed(entries, fit(entries, threshold, target), code), "index")
    found = cut_lineage(compared(blocks(index), code, threshold), "found")
    counts = found.filter("links IS NOT NULL").groupBy("vid").agg(F.sum("links").alias("links"))
    roots = components(found.filter("root IS NOT NULL").select(F.col("vid").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "vid")
    rooted = entries.select("vid", "low", "n").join(counts, "vid", "left").join(roots, "vid", "left")
    rooted = cut_lineage(rooted.withColumn("root", F.coalesce("root", "vid")), "rooted")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    joined = rooted.join(least, "root").select("vid", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id", F.col("n").alias("_n"))
    linked = lookup_join(whole.select("id", "vid"), joined, "vid").select("id", "n_links", "component_id")
    alone = named.filter("v IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = linked.unionByName(alone)
    return every.select(F.col("id").alias(key), F.col("n_links").cast("long").alias("n_links"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
