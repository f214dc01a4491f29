"""Similarity of page and query vectors."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.operators.ordering import lookup_join
from pagemill.storage import cut_lineage

# Distance that covers a query, its decay, and the thresholds.
COVERAGE_RADIUS = 0.2
DECAY = 3.0
IRRELEVANT_BELOW = 0.1
OVERLAP = 0.85

QUERY_BLOCK = 1_000
MAX_PIVOTS = 512
BLOCK_ROWS = 4_000
COMPARED_ROWS = 4_000
GRID = 8
TASK_ROWS = 64_000
ROUNDING = 1e-5  # of a product of unit vectors in single precision, besides what its width adds


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of unit length in double precision; a zero vector stays zero."""
    matrix = np.stack(vectors.to_numpy()).astype(np.float64)
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def _packed(rows: DataFrame, name: str, per_block: int) -> DataFrame:
    """``ids`` and ``data`` of about ``per_block`` rows of ``id, v`` a block, as binary doubles; ``name`` numbers the blocks from 0."""
    count = max(1, math.ceil(rows.count() / per_block))
    schema = T.StructType([T.StructField(name, T.IntegerType()), T.StructField("ids", T.ArrayType(rows.schema["id"].dataType)), T.StructField("data", T.BinaryType())])

    def pack(key: tuple, block: pa.Table) -> pa.Table:
        data = _unit(block.column("v").to_pandas()).tobytes()
        columns = [[key[0].as_py()], [block.column("id").to_pylist()], [data]]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, to_arrow_schema(schema), strict=True)], schema=to_arrow_schema(schema))

    dealt = rows.withColumn(name, F.pmod(F.xxhash64("id", "v"), F.lit(count)).cast("int"))
    return cut_lineage(dealt.groupBy(name).applyInArrow(pack, schema), "blocks")


def best_matches(pages: DataFrame, queries: DataFrame, query_id: str, vector: str = "embedding") -> DataFrame:
    """The highest cosine any page reaches for each query.

    Queries and pages are packed into blocks by the tasks; pages are read once.
    Every block of pages meets every block of queries, and such a pair gives one
    row a query, so what is shuffled after that is small. Vectors without a
    value are left out; without pages there are no rows.
    """
    asked = queries.filter(F.col(vector).isNotNull()).select(F.col(query_id).alias("id"), F.col(vector).alias("v"))
    held = pages.filter(F.col(vector).isNotNull()).select(F.lit(None).cast("long").alias("id"), F.col(vector).alias("v"))
    asking, answering = _packed(asked, "query_block", QUERY_BLOCK), _packed(held, "page_block", BLOCK_ROWS).drop("ids")
    blocks = asking.agg(F.max("query_block")).first()[0]
    schema = T.StructType([queries.schema[query_id], T.StructField("similarity", T.DoubleType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = batch.column("ids")[k].as_py()
                matrix = np.frombuffer(batch.column("data")[k].as_py()).reshape(len(ids), -1)
                best = np.full(len(ids), -np.inf)
                page = np.frombuffer(batch.column("pages")[k].as_py()).reshape(-1, matrix.shape[1])
                for at in range(0, len(page), QUERY_BLOCK):
                    best = np.maximum(best, (page[at : at + QUERY_BLOCK] @ matrix.T).max(axis=0))
                yield pa.RecordBatch.from_arrays([pa.array(ids, arrow[0].type), pa.array(best)], schema=arrow)

    numbers = F.sequence(F.lit(0), F.lit(blocks if blocks is not None else 0))
    paired = answering.select(F.col("data").alias("pages"), F.explode(numbers).alias("query_block"))
    found = paired.join(asking, "query_block").select("pages", "ids", "data").mapInArrow(run, schema)
    return found.groupBy(query_id).agg(F.max("similarity").alias("similarity"))


def embedding_coverage(
    pages: DataFrame,
    queries: DataFrame,
    query_id: str,
    vector: str = "embedding",
    radius: float = COVERAGE_RADIUS,
    decay: float = DECAY,
) -> DataFrame:
    """Distance of the nearest page to each query, whether it covers it, and a score that decays beyond."""
    nearest = best_matches(pages, queries, query_id, vector)
    distance = 1 - F.col("similarity")
    return nearest.select(
        query_id,
        distance.alias("distance"),
        (distance <= radius).alias("covered"),
        F.exp(-F.lit(decay) * F.greatest(distance - radius, F.lit(0.0))).alias("score"),
    )


def coverage_summary(coverage: DataFrame, least: float = IRRELEVANT_BELOW) -> DataFrame:
    """Share of covered queries, mean score, and whether the pages are unrelated to the query."""
    confidence = F.avg("score")
    return coverage.agg(
        F.count("*").alias("queries"),
        F.avg(F.col("covered").cast("double")).alias("coverage"),
        confidence.alias("confidence"),
        (confidence < least).alias("is_irrelevant"),
    )


def near_duplicates(df: DataFrame, key: str, threshold: float = OVERLAP, vector: str = "embedding") -> DataFrame:
    """The earliest near copy before each vector: ``(key, duplicate_of)``, exact for any threshold.

    Only the earliest copy is given, so a large group of copies gives one row a
    vector. Equal vectors are folded to their first key before anything is
    compared. The others are put in the cell of their nearest pivot; a vector
    also visits a cell whose border is within the threshold distance, since
    only such cells can hold a copy of it. Neighbouring cells make up chunks,
    and the visitors of a chunk are dealt to slices: a vector travels once to
    each slice of its chunk and once to each chunk it visits, however many cells
    that are. There are ``GRID`` of either, more only if a task would hold over
    ``TASK_ROWS`` members, so what is shuffled grows with the vectors.
    """
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("v").isNotNull())
    folded = rows.groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("_n"))
    folded = cut_lineage(folded, "vectors")
    return _with_copies(rows, folded, _earliest_near(_vectors(folded), threshold), key)


def likely_duplicates(
    df: DataFrame, key: str, threshold: float = OVERLAP, vector: str = "embedding", recall: float = 0.97, bits: int = 12, seed: int = 7
) -> DataFrame:
    """Like :func:`near_duplicates`, of about a share ``recall`` of the vectors that have a copy, for large tables.

    Each of some bands gives a vector ``bits`` signs, those of its products with
    seeded random hyperplanes; vectors with the same signs in a band are
    compared. A pair at the threshold agrees in a sign with the probability
    ``1 - angle / pi``; there are as many bands as make it meet with the
    probability ``recall``, nearer pairs meet more surely. What meets is
    verified, so no pair below the threshold is given. At 0.85, 12 bits and 0.97
    that are 35 bands; of unrelated vectors one pair in 120 is compared. A vector
    travels once a band, in single precision.
    """
    agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(agree**bits, 1 - 1e-12))))
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("v").isNotNull())
    folded = cut_lineage(rows.groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("_n")), "vectors")
    vectors = _vectors(folded)
    counts = _banded(vectors, bands, bits, seed, False).groupBy("cell").count()
    crowded = cut_lineage(counts.filter(F.col("count") > BLOCK_ROWS), "crowded-cells")
    found = _earliest_in_cells(_banded(vectors, bands, bits, seed), crowded, threshold)
    return _with_copies(rows, folded, _verified(found, vectors, threshold), key)


def _vectors(folded: DataFrame) -> DataFrame:
    return folded.filter(F.col("first").isNotNull()).select(F.col("first").alias("id"), "v")


def _with_copies(rows: DataFrame, folded: DataFrame, near: DataFrame, key: str) -> DataFrame:
    """The earlier of an equal vector and the near one of ``near(id, near)``, for every row that has either."""
    copies = folded.join(near.withColumnRenamed("id", "first"), "first", "left")
    copy = F.least(F.when(F.col("first") < F.col("id"), F.col("first")), F.col("near"))
    joined = lookup_join(rows, copies, "v")
    return joined.select(F.col("id").alias(key), copy.alias("duplicate_of")).filter(F.col("duplicate_of").isNotNull())


def _banded(vectors: DataFrame, bands: int, bits: int, seed: int, whole: bool = True) -> DataFrame:
    """``cell, id, v``: every vector once a band, the cell being the band and its signs; only the cells if not ``whole``."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), QUERY_BLOCK):
                part = batch.iloc[at : at + QUERY_BLOCK]
                unit = _unit(part["v"])
                width = unit.shape[1]
                if width not in planes:
                    planes[width] = np.random.default_rng(seed).normal(size=(width, bands * bits))
                signs = (unit @ planes[width] > 0).reshape(len(part), bands, bits)
                cells = (signs @ weights) + (np.arange(bands, dtype=np.int64) << bits)
                if whole:
                    data = np.repeat(np.array([u.tobytes() for u in unit.astype(np.float32)], object), bands)
                    yield pd.DataFrame({"cell": cells.ravel(), "id": np.repeat(part["id"].to_numpy(), bands), "v": data})
                else:
                    yield pd.DataFrame({"cell": cells.ravel()})

    return vectors.mapInPandas(place, "cell long, id long, v binary" if whole else "cell long")


def _earliest_near(vectors: DataFrame, threshold: float) -> DataFrame:
    # A bounded, repeatable choice of pivots, one for each block of vectors: the lowest hashes.
    total = vectors.count()
    wanted = min(math.ceil(total / BLOCK_ROWS), MAX_PIVOTS)
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(wanted).toPandas()
    if chosen.empty:
        return vectors.select("id", F.lit(None).cast("long").alias("near"))
    pivots = _unit(chosen["v"])
    between = np.linalg.norm(pivots[:, None, :] - pivots[None, :, :], axis=2)
    reach = math.sqrt(max(2 - 2 * threshold, 0.0)) + 1e-9
    spread = np.where(between > 0, between, np.inf)

    def borders(unit: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Distance to the border between the home cell and every other cell."""
        squares = 2 - 2 * (unit @ pivots.T)
        return (squares - squares[np.arange(len(unit)), home][:, None]) / (2 * spread[home])

    def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame({"home": (2 - 2 * (_unit(batch["v"]) @ pivots.T)).argmin(axis=1), "id": batch["id"], "v": batch["v"]})

    homes = cut_lineage(vectors.mapInPandas(settle, T.StructType([T.StructField("home", T.IntegerType()), *vectors.schema.fields])), "cells")
    # At most one row for each pivot.
    held = {r["home"]: r["count"] for r in homes.groupBy("home").count().collect()}
    grid = max(GRID, math.ceil(total / TASK_ROWS))
    first, parts, at, room = np.zeros(len(pivots), int), np.ones(len(pivots), int), 0, math.ceil(total / grid)
    filled = 0
    for cell in range(len(pivots)):
        if filled and filled + held.get(cell, 0) > room:
            at, filled = at + 1, 0
        first[cell], parts[cell] = at, max(1, math.ceil(held.get(cell, 0) / room))
        filled += held.get(cell, 0)
        if parts[cell] > 1:  # a cell larger than a chunk: its members are dealt to chunks of its own
            at, filled = at + int(parts[cell]), 0
    chunk_of = np.zeros((len(pivots), int((first + parts).max())), bool)
    for cell in range(len(pivots)):
        chunk_of[cell, first[cell] : first[cell] + parts[cell]] = True

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for begin in range(0, len(whole), QUERY_BLOCK):
                batch = whole.iloc[begin : begin + QUERY_BLOCK]
                unit, home, spot = _unit(batch["v"]), batch["home"].to_numpy(), batch["spot"].to_numpy()
                data, ids = np.array([u.tobytes() for u in unit.astype(np.float32)], object), batch["id"].to_numpy()
                visited = (borders(unit, home) <= reach).astype(np.float32) @ chunk_of.astype(np.float32) > 0
                row, chunk = np.nonzero(visited)
                member, slices = np.repeat(np.arange(len(batch)), grid), np.tile(np.arange(grid), len(batch))
                for own, r, c, s in ((0, member, (first[home] + (spot // grid) % parts[home])[member], slices), (1, row, chunk, (spot % grid)[row])):
                    yield pd.DataFrame({"cell": c, "part": s, "own": own, "home": home[r], "id": ids[r], "v": data[r]})

    def pairs(group: dict[str, np.ndarray], unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        member, visitor = np.flatnonzero(group["own"] == 0), np.flatnonzero(group["own"] == 1)
        near = borders(unit[visitor], group["home"][visitor]) <= reach + ROUNDING
        cells = group["home"][member]
        for cell in np.unique(cells):
            yield visitor[near[:, cell]], member[cells == cell]

    spot = F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("spot")
    dealt = homes.select("home", "id", "v", spot).mapInPandas(deal, "cell int, part int, own int, home int, id long, v binary")
    return _verified(_compared(dealt, ["cell", "part"], pairs, threshold), vectors, threshold)


def _earliest_in_cells(placed: DataFrame, crowded: DataFrame, threshold: float) -> DataFrame:
    """What :func:`_compared` finds in every cell of ``placed(cell, id, v)``.

    A cell of ``crowded(cell, count)`` is cut into blocks, and each pair of
    blocks is compared by itself.
    """
    blocks = F.coalesce(F.ceil(F.col("count") / F.lit(BLOCK_ROWS)), F.lit(1)).cast("int")
    sized = placed.join(F.broadcast(crowded), "cell", "left").select("cell", "id", "v", blocks.alias("blocks"))
    sized = sized.withColumn("own", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    spread = sized.select("cell", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"), F.lit(0).alias("home"), "id", "v")
    dealt = spread.select("cell", F.least("own", "other").alias("part"), F.greatest("own", "other").alias("other"), "own", "home", "id", "v")

    def pairs(group: dict[str, np.ndarray], unit: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        one, two = (np.flatnonzero(group["own"] == group[c][0]) for c in ("part", "other"))
        yield one, two
        if group["part"][0] != group["other"][0]:
            yield two, one

    return _compared(dealt, ["cell", "part", "other"], pairs, threshold)


def _earliest(visitor: np.ndarray, member: np.ndarray, ids: np.ndarray, unit: np.ndarray, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Of the members before a visitor the earliest that is near for certain, and those before it that may be."""
    member = member[np.argsort(ids[member], kind="stable")]
    blur = ROUNDING + unit.shape[1] * 1.2e-7
    for at in range(0, len(visitor), QUERY_BLOCK):
        left = visitor[at : at + QUERY_BLOCK]
        for start in range(0, len(member), COMPARED_ROWS):
            some = member[start : start + COMPARED_ROWS]
            left = left[ids[left] > ids[some[0]]]
            if not len(left):
                break
            score = unit[left] @ unit[some].T
            before = ids[some][None, :] < ids[left][:, None]
            sure = before & (score >= threshold + blur)
            hit, place = sure.any(axis=1), sure.argmax(axis=1)
            yield ids[left[hit]], ids[some[place[hit]]], True
            row, column = np.nonzero(before & (score >= threshold - blur) & ~sure)
            early = ~hit[row] | (column < place[row])
            yield ids[left[row[early]]], ids[some[column[early]]], False
            left = left[~hit]


def _compared(dealt: DataFrame, keys: list[str], pairs: Callable, threshold: float) -> DataFrame:
    """``id, near, sure`` of the groups of ``dealt`` by ``keys``; ``pairs`` tells which rows of a group visit which members."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("near", T.LongType()), T.StructField("sure", T.BooleanType())])
    arrow = to_arrow_schema(schema)
    columns = [*keys, "own", "home", "id"]

    def done(table: pa.Table, first: np.ndarray) -> Iterator[pa.RecordBatch]:
        held = {c: table.column(c).to_numpy() for c in columns}
        data = table.column("v")
        for a, b in zip(first, [*first[1:], len(table)], strict=True):
            if b - a > 1:
                unit = np.frombuffer(b"".join(data.slice(a, b - a).to_pylist()), np.float32).reshape(b - a, -1)
                group = {c: x[a:b] for c, x in held.items()}
                for visitor, member in pairs(group, unit):
                    for one, other, sure in _earliest(visitor, member, group["id"], unit, threshold):
                        if len(one):
                            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(other), pa.array(np.full(len(one), sure))], schema=arrow)

    def edges(table: pa.Table) -> np.ndarray:
        numbers = np.column_stack([table.column(c).to_numpy() for c in keys])
        return np.flatnonzero(np.r_[True, (numbers[1:] != numbers[:-1]).any(axis=1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The groups of a task one after the other; there can be very many of a few vectors."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if held and any(batch.column(c)[-1] != held[-1].column(c)[-1] for c in keys):
                table = pa.Table.from_batches([*held, batch])
                first = edges(table)
                last = int(first[-1])  # the last group can go on in the next batch
                yield from done(table.slice(0, last), first[:-1])
                held = table.slice(last).combine_chunks().to_batches()
            else:
                held.append(batch)
        if held:
            table = pa.Table.from_batches(held)
            yield from done(table, edges(table))

    spread = dealt.repartition(*keys).sortWithinPartitions(*keys)
    return spread.select(*columns, "v").mapInArrow(run, schema)


def _verified(found: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """``id, near``: the earliest near one of each, what single precision can't decide by the whole vectors."""
    found = cut_lineage(found.groupBy("id", "near").agg(F.max("sure").alias("sure")), "found")

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                close = (_unit(batch["v"]) * _unit(batch["w"])).sum(axis=1) >= threshold
                yield batch.loc[close, ["id", "near"]]

    unsure = found.filter("NOT sure").select("id", "near").join(vectors, "id")
    unsure = unsure.join(vectors.select(F.col("id").alias("near"), F.col("v").alias("w")), "near")
    both = found.filter("sure").select("id", "near").unionByName(unsure.mapInPandas(check, "id long, near long"))
    return both.groupBy("id").agg(F.min("near").alias("near"))
