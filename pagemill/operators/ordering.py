"""Numbering and running sums over a long sequence, without a one-task sort.

A window over a whole table, or over a group that holds a third of it, is one
task. Here the sequence is cut at quantiles of its order column. Each piece is
numbered by itself, and the totals of the pieces before it, a few rows a
group, are added. The cut points are plain literals, so that a lost task is
recomputed to the same pieces.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.storage import cut_lineage, plan_bytes

ROWS_PER_PIECE = 1_000_000
MAX_PIECES = 10_000
HOT_KEYS = 1_000
BROADCAST_BYTES = 8 << 20
PIECE = "_piece"


def cut_points(df: DataFrame, order: str, rows: int = ROWS_PER_PIECE) -> list[float]:
    """Quantiles of the numeric ``order`` column that cut it into pieces of about ``rows`` rows."""
    if not isinstance(df.schema[order].dataType, T.NumericType):
        raise ValueError(f"order column {order} must be numeric; of a timestamp take unix_micros")
    pieces = min(math.ceil(df.select(order).count() / rows), MAX_PIECES)
    if pieces <= 1:
        return []
    return sorted(set(df.stat.approxQuantile(order, [i / pieces for i in range(1, pieces)], 0.25 / pieces)))


def with_pieces(df: DataFrame, order: str, cuts: Sequence[float]) -> DataFrame:
    """Add ``_piece``, the number of the range of ``order`` a row is in."""
    if not cuts:
        return df.withColumn(PIECE, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    bucketizer = Bucketizer(splits=splits, inputCol=order, outputCol=PIECE, handleInvalid="keep")
    return bucketizer.transform(df).withColumn(PIECE, F.col(PIECE).cast("int"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet; the right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, weight: str = "_n") -> DataFrame:
    """Add the columns of ``lookup``, which has one row for every key in ``rows``.

    ``weight`` is a key's number of rows. The lookup is written first, so its
    size is known: a small one is broadcast as it is. Of a larger one the
    heaviest keys, at most ``HOT_KEYS`` of them, are broadcast, so their rows
    stay where they are; a key that is left for the shuffle has less than one
    in ``HOT_KEYS`` of all rows. Null keys meet.
    """
    stored = cut_lineage(lookup, "lookup")
    if plan_bytes(stored) <= BROADCAST_BYTES:
        return null_safe_join(rows, F.broadcast(stored.drop(weight)), [key])
    hot = stored.orderBy(F.desc(weight), F.asc(key)).limit(HOT_KEYS).drop(weight)
    spread = null_safe_join(rows, F.broadcast(hot), [key])
    others = null_safe_join(stored.drop(weight), F.broadcast(hot.select(key)), [key], "left_anti")
    rest = null_safe_join(rows, F.broadcast(hot.select(key)), [key], "left_anti")
    return spread.unionByName(null_safe_join(rest, others, [key]))


def with_running_sums(
    df: DataFrame,
    order: str | Sequence[str],
    sums: dict[str, Column],
    group: Sequence[str] = (),
    rows: int = ROWS_PER_PIECE,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Add inclusive running sums by ``order`` within ``group``.

    ``order`` is one column or several, unique together within a group; the
    first is numeric, and the pieces are cut by it. ``cuts`` saves finding the
    cut points again.
    """
    order = [order] if isinstance(order, str) else list(order)
    cuts = cut_points(df, order[0], rows) if cuts is None else cuts
    kept = [c for c in df.columns if c not in sums]
    if not cuts:
        whole = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({name: F.sum(value).over(whole) for name, value in sums.items()}).select(*kept, *sums)
    pieced = with_pieces(df.withColumns({f"_v_{n}": v for n, v in sums.items()}), order[0], cuts)
    # One struct as the key of window and join alike: a single shuffle serves both, and null groups meet.
    keyed = pieced.withColumn("_key", F.struct(*group, PIECE))
    totals = keyed.groupBy("_key").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    earlier = Window.partitionBy(*[F.col("_key")[g] for g in group]).orderBy(F.col("_key")[PIECE])
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_key", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums])
    within = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = keyed.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(within) for n in sums})
    full = [(F.col(f"_b_{n}") + F.col(f"_l_{n}")).alias(n) for n in sums]
    return local.join(before, "_key").select(*kept, *full)


def with_index(
    df: DataFrame,
    order: str | Sequence[str],
    group: Sequence[str] = (),
    name: str = "index",
    rows: int = ROWS_PER_PIECE,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Add the position by ``order`` within ``group``, from 0; rows that tie are numbered in any order.

    ``order`` is one column or several, of which the first is numeric. Only the
    distinct keys are counted and summed up, piece by piece. The rows, which
    may hold whole texts, are joined to the number of rows before their key and
    counted on within it, so each row meets one number however many tie.
    """
    order = [order] if isinstance(order, str) else list(order)
    keys = [*group, *order]
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    counts = cut_lineage(counts, "order-keys")
    cuts = cut_points(counts, order[0], rows) if cuts is None else cuts
    ends = with_running_sums(counts, order, {"_end": F.col("_n")}, group, cuts=cuts)
    # One struct as the key of join and window alike: a single shuffle serves both, and null groups meet.
    before = ends.select(F.struct(*keys).alias("_key"), (F.col("_end") - F.col("_n")).alias("_before"))
    keyed = df.withColumn("_key", F.struct(*keys)).join(before, "_key")
    within = F.row_number().over(Window.partitionBy("_key").orderBy("_key"))
    return keyed.withColumn(name, F.col("_before") + within - 1).select(*[c for c in df.columns if c != name], name)


def with_previous(
    df: DataFrame,
    order: str,
    column: str,
    name: str,
    group: Sequence[str] = (),
    rows: int = ROWS_PER_PIECE,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Add the value of the row before; the first row of a piece takes the last value of the piece before."""
    cuts = cut_points(df, order, rows) if cuts is None else cuts
    if not cuts:
        return df.withColumn(name, F.lag(column).over(Window.partitionBy(*group).orderBy(order)))
    keyed = with_pieces(df, order, cuts).withColumn("_key", F.struct(*group, PIECE))
    last = keyed.groupBy("_key").agg(F.max_by(column, order).alias("_last"))
    by_piece = Window.partitionBy(*[F.col("_key")[g] for g in group]).orderBy(F.col("_key")[PIECE])
    carried = last.select("_key", F.lag("_last").over(by_piece).alias("_carried"))
    within = Window.partitionBy("_key").orderBy(order)
    local = keyed.withColumns({"_before": F.lag(column).over(within), "_row": F.row_number().over(within)})
    value = F.when(F.col("_row") == 1, F.col("_carried")).otherwise(F.col("_before"))
    return local.join(carried, "_key").select(*df.columns, value.alias(name))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key.

    Spark prunes ``row_number() = 1`` to one row a key and task before the
    shuffle, so a key with a third of all rows costs no more than the others.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, name: str = "rank") -> DataFrame:
    """The first ``n`` rows of every key with their rank; pruned before the shuffle as well."""
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    return ranked.filter(F.col(name) <= n)
