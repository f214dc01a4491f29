"""Batch preparation before a model call, and the report after it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions.text import estimate_tokens, nonempty, words
from pagemill.operators.exploding import number_items
from pagemill.operators.ordering import BROADCAST_BYTES, PIECE, ROWS_PER_PIECE, cut_points, null_safe_join, with_index, with_pieces
from pagemill.storage import cut_lineage, plan_bytes

# Batch size, separators and token limits.
BATCH_SIZE = 1000
PRODUCT_SEPARATOR = "\n\n---PRODUCT-SEPARATOR---\n\n"
TABLE_SEPARATOR = "\n\n---TABLE-SEPARATOR---\n\n"
TOKEN_LIMIT = 80_000
CHUNK_TOKENS = 500
PACK_PIECE = 200_000
PIECES_AT_ONCE = 64


def with_tokens(df: DataFrame, text: str = "text", into: str = "tokens") -> DataFrame:
    return df.withColumn(into, estimate_tokens(F.col(text)))


def joined_text(df: DataFrame, by: Sequence[str], text: str, order: str, separator: str) -> DataFrame:
    """One row for each batch: its size and its texts in order. Batches are bounded by their maker."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    joined = F.array_join(F.transform(pairs, lambda p: p["t"]), separator)
    return df.groupBy(*by).agg(F.count("*").alias("n"), joined.alias("batch_text"))


def fixed_batches(
    df: DataFrame,
    text: str,
    order: str | Sequence[str],
    size: int = BATCH_SIZE,
    separator: str = PRODUCT_SEPARATOR,
    piece_rows: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Batches of ``size`` records in order, joined by a separator line; records that tie are all kept."""
    order = [order] if isinstance(order, str) else list(order)
    numbered = with_index(df.select(*dict.fromkeys([*order, text])), order, name="_index", rows=piece_rows)
    numbered = numbered.withColumn("batch_no", F.floor(F.col("_index") / F.lit(size)))
    return joined_text(numbered, ["batch_no"], text, "_index", separator)


# Packing. Whether an item opens a batch depends on all items before it, but
# only through the sum of the open batch. A piece of the sequence is therefore
# described by what it does to that sum: the first item it opens a batch at,
# which is the later the smaller the sum is, and from there on a fixed course.
# Pieces are described in parallel, the descriptions (one row for each possible
# first opening) are composed, and the pieces are then numbered in parallel. What
# two neighbours do one after the other is a description of the same form, so
# the pieces of a long sequence are composed as a tree, a bounded number at once.

_MAP = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("least_sum", T.LongType()),  # smallest entry sum of this course; -1: nothing is open yet
        T.StructField("opened", T.LongType()),  # batches opened in the piece
        T.StructField("end_sum", T.LongType()),  # exit sum, or what the piece adds if it opens none
    ]
)


_COURSE = ["least_sum", "opened", "end_sum"]


def _following(tokens: np.ndarray, limit: int) -> np.ndarray:
    """For a batch opened at each item, the item that opens the next one."""
    total = np.concatenate(([0], np.cumsum(tokens)))
    # The batch opened at i closes at the first later j with total[j + 1] - total[i] >= limit.
    closes = np.searchsorted(total[1:], total[:-1] + limit, side="left")
    return np.maximum(closes, np.arange(len(tokens)) + 1)


def _courses(tokens: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Openings and exit sum of the course that opens a batch at each item, by doubling the jumps."""
    n = len(tokens)
    following = _following(tokens, limit)
    jump = np.where(following < n, following, np.arange(n))
    jumps = (following < n).astype(np.int64)
    while (jump[jump] != jump).any():
        jumps += jumps[jump]
        jump = jump[jump]
    return jumps + 1, tokens.sum() - np.concatenate(([0], np.cumsum(tokens)))[jump]


def _describe(tokens: np.ndarray, limit: int) -> pd.DataFrame:
    total = np.cumsum(tokens)
    opened, exit_sum = _courses(tokens, limit)
    # With entry sum s the first opening is the first i with s + total[i] >= limit.
    reach = np.maximum(limit - total, 0)
    first = np.flatnonzero(np.concatenate(([True], reach[1:] < reach[:-1])))
    first = first[::-1]
    found = pd.DataFrame({"least_sum": reach[first], "opened": opened[first], "end_sum": exit_sum[first]})
    # Neighbouring courses soon meet; those that end alike are one.
    same = (found[["opened", "end_sum"]] == found[["opened", "end_sum"]].shift()).all(axis=1)
    extra = [(-1, int(opened[0]), int(exit_sum[0]))]
    if reach[-1] > 0:
        extra.append((0, 0, int(total[-1])))
    return pd.concat([pd.DataFrame(extra, columns=found.columns), found[~same]], ignore_index=True)


def _follow(courses: pd.DataFrame, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Batches opened and exit sum for every entry sum; the courses are in order."""
    least, opened, ends = (courses[c].to_numpy(dtype=np.int64) for c in _COURSE)
    at = np.searchsorted(least, sums, side="right") - 1
    return opened[at], ends[at] + np.where(opened[at] > 0, 0, sums)


def _compose(first: pd.DataFrame, second: pd.DataFrame) -> pd.DataFrame:
    """What two pieces do one after the other."""
    first, second = first.sort_values("least_sum"), second.sort_values("least_sum")
    least = first["least_sum"].to_numpy(dtype=np.int64)
    # Where the first piece opens nothing its exit sum moves with the entry sum, and the second piece's steps are seen.
    added = first.loc[first["opened"] == 0, "end_sum"].to_numpy(dtype=np.int64)
    moved = (second["least_sum"].to_numpy(dtype=np.int64) - added[0]) if len(added) else least[:0]
    entry = np.unique(np.concatenate([least, moved[moved > 0]]))
    middle, between = _follow(first, entry)
    last, left = _follow(second, between)
    opened = middle + last
    found = pd.DataFrame({"least_sum": entry, "opened": opened, "end_sum": np.where(opened > 0, left, left - entry)})
    same = (found[["opened", "end_sum"]] == found[["opened", "end_sum"]].shift()).all(axis=1)
    return found[~same]


def _number(tokens: np.ndarray, limit: int, open_sum: int) -> np.ndarray:
    """1 at every item that opens a batch."""
    opens = np.zeros(len(tokens), dtype=np.int64)
    following = _following(tokens, limit)
    if open_sum < 0:
        at = 0
    else:
        at = int(np.searchsorted(np.cumsum(tokens), limit - open_sum, side="left"))
    while at < len(tokens):
        opens[at] = 1
        at = int(following[at])
    return opens


def pack_batches(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    limit: int = TOKEN_LIMIT,
    tokens: str = "tokens",
    piece_rows: int = PACK_PIECE,
) -> DataFrame:
    """Greedy in-order packing of each group into batches below a token limit.

    An item above the limit is left out; one that fits under it joins the open
    batch if the sum stays below the limit, and opens the next batch if not.
    Adds ``batch_no`` from 0; an item as large as the limit is a batch of its own.

    A group is worked on in pieces of about ``piece_rows`` rows, so that a
    group with a third of all items spreads over as many tasks as its share.
    Items that tie in ``order`` follow each other by size.
    """
    group = list(group)
    # Items alike in group, order and size can stand for each other; their number among themselves tells them apart.
    alike = Window.partitionBy(*group, order, "_tokens").orderBy("_tokens")
    kept = df.filter(F.col(tokens) <= limit).withColumn("_tokens", F.col(tokens).cast("long"))
    kept = kept.withColumn("_tie", F.row_number().over(alike))
    # The sizes are written once; counting and cutting them does not read the texts again.
    sizes = cut_lineage(kept.select(*group, order, "_tokens", "_tie"), "sizes")
    cuts = cut_points(sizes, order, piece_rows)
    keys = [sizes.schema[g] for g in group]
    names = [*group, PIECE]

    def number(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([order, "_tokens", "_tie"])
        opens = _number(rows["_tokens"].to_numpy(dtype=np.int64), limit, int(rows["_open_sum"].iloc[0]))
        batch_no = rows["_batches"].to_numpy(dtype=np.int64) + np.cumsum(opens) - 1
        return rows.assign(batch_no=batch_no)[[*group, order, "_tokens", "_tie", "batch_no"]]

    small, large = _by_group_size(sizes, group, piece_rows) if cuts else (sizes, None)
    start = {PIECE: F.lit(0), "_open_sum": F.lit(-1).cast("long"), "_batches": F.lit(0).cast("long")}
    entered = small.withColumns(start)
    if large is not None:
        pieces = with_pieces(large, order, cuts)
        # Never a broadcast: sizes take a byte or less a row in a file, as they repeat, and a hundred in memory.
        entered = entered.unionByName(null_safe_join(pieces.hint("merge"), _entries(pieces, group, order, limit, len(cuts) + 1), names))
    items = [sizes.schema[c] for c in (order, "_tokens", "_tie")]
    schema = T.StructType([*keys, *items, T.StructField("batch_no", T.LongType())])
    numbered = entered.groupBy(*names).applyInPandas(number, schema)
    if set(df.columns) == {*group, order, tokens}:
        return numbered.withColumn(tokens, F.col("_tokens").cast(df.schema[tokens].dataType)).select(*df.columns, "batch_no")
    return null_safe_join(kept.hint("merge"), numbered, [*group, order, "_tokens", "_tie"]).select(*df.columns, "batch_no")


def _by_group_size(sizes: DataFrame, group: list[str], piece_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the groups that fit in a piece, and of the others; of those there are at most as many as pieces."""
    if not group:
        return sizes.limit(0), sizes
    large = sizes.groupBy(*group).count().filter(F.col("count") > piece_rows).drop("count")
    large = cut_lineage(large, "large-groups")
    large = F.broadcast(large) if plan_bytes(large) <= BROADCAST_BYTES else large
    return null_safe_join(sizes, large, group, "left_anti"), null_safe_join(sizes, large, group, "left_semi")


def _entries(pieces: DataFrame, group: list[str], order: str, limit: int, n_pieces: int) -> DataFrame:
    """Sum of the open batch and number of batches before each piece."""
    keys = [pieces.schema[g] for g in group]

    def describe(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        sizes = rows.sort_values([order, "_tokens", "_tie"])["_tokens"].to_numpy(dtype=np.int64)
        found = _describe(sizes, limit)
        for position, name in enumerate(group):
            found[name] = key[position]
        return found.assign(piece=key[-1])[[*group, "piece", "least_sum", "opened", "end_sum"]]

    described = pieces.groupBy(*group, PIECE).applyInPandas(describe, T.StructType([*keys, *_MAP.fields]))
    return _enter(described, group, n_pieces)


def _enter(described: DataFrame, group: list[str], n_pieces: int) -> DataFrame:
    """State before each piece: upwards, blocks of neighbours are composed; downwards, each block tells its parts.

    No task sees more than ``PIECES_AT_ONCE`` descriptions, each of at most as
    many rows as there are different sums.
    """
    keys = [described.schema[g] for g in group]
    entry = T._parse_datatype_string(f"{PIECE} int, _open_sum long, _batches long")
    block = F.floor(F.col("piece") / F.lit(PIECES_AT_ONCE)).cast("int").alias("_block")

    def compose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = reduce(_compose, [courses[_COURSE] for _, courses in rows.groupby("piece", sort=True)])
        return found.assign(piece=key[-1], **dict(zip(group, key[:-1], strict=True)))[[*group, "piece", *_COURSE]]

    def chain(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out, open_sum, batches = [], int(rows["_open_sum"].iloc[0]), int(rows["_batches"].iloc[0])
        for piece, courses in rows.groupby("piece", sort=True):
            out.append((*key[:-1], piece, open_sum, batches))
            opened, left = _follow(courses.sort_values("least_sum"), np.array([open_sum]))
            open_sum, batches = int(left[0]), batches + int(opened[0])
        return pd.DataFrame(out, columns=[*group, PIECE, "_open_sum", "_batches"])

    levels = [cut_lineage(described, "courses")]
    while n_pieces > PIECES_AT_ONCE:
        n_pieces = -(-n_pieces // PIECES_AT_ONCE)
        above = levels[-1].groupBy(*group, block).applyInPandas(compose, T.StructType([*keys, *_MAP.fields]))
        levels.append(cut_lineage(above, "courses"))
    start = {"_open_sum": F.lit(-1).cast("long"), "_batches": F.lit(0).cast("long")}
    top = levels.pop().withColumns({"_block": F.lit(0)} | start)
    entries = top.groupBy(*group, "_block").applyInPandas(chain, T.StructType([*keys, *entry.fields]))
    while levels:
        above = cut_lineage(entries.withColumnRenamed(PIECE, "_block"), "entries")
        # Nor are the courses, for the same reason.
        parts = null_safe_join(levels.pop().withColumn("_block", block).hint("merge"), above, [*group, "_block"])
        entries = parts.groupBy(*group, "_block").applyInPandas(chain, T.StructType([*keys, *entry.fields]))
    return entries


def build_prompts(
    df: DataFrame, template: str, batch: str = "batch_text", known: Sequence[str] = (), into: str = "prompt"
) -> DataFrame:
    """Request table: ``{batch}`` and ``{known}`` of the template filled for each row.

    ``known`` are columns with fields already found, given as JSON with nulls.
    """
    fields = F.to_json(F.struct(*known), {"ignoreNullFields": "false"}) if known else F.lit("{}")
    parts: list[Column] = []
    for piece in _template_parts(template):
        parts.append({"{batch}": F.col(batch), "{known}": fields}.get(piece, F.lit(piece)))
    return df.withColumn(into, F.concat(*parts))


def _template_parts(template: str) -> list[str]:
    parts = [template]
    for mark in ("{batch}", "{known}"):
        parts = [p for part in parts for i, s in enumerate(part.split(mark)) for p in (([mark] if i else []) + [s]) if p]
    return parts


def chunk_text(df: DataFrame, size: int = CHUNK_TOKENS, overlap: int = 0, text: str = "text") -> DataFrame:
    """Word windows of ``size`` words that start every ``size - overlap`` words."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    rest = [c for c in df.columns if c != text]
    cut = df.select(*rest, words(F.col(text)).alias("_words"))
    # The last window is the first that reaches the end.
    last = F.greatest(F.ceil((F.size("_words") - F.lit(size)) / F.lit(size - overlap)), F.lit(0)).cast("int")
    windows = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("_words", i * (size - overlap) + 1, F.lit(size)))
    rows = number_items(cut, rest, F.when(F.size("_words") > 0, windows), "chunk_no", "_window", 0)
    return rows.select(
        *rest, "chunk_no", F.size("_window").cast("long").alias("n_words"), F.array_join("_window", " ").alias("chunk")
    )


def chunk_by_regex(df: DataFrame, pattern: str = r"\n\n", text: str = "text") -> DataFrame:
    """Pieces between matches of a pattern, blank ones dropped."""
    from pagemill.sources.readers import split_blocks

    rest = [c for c in df.columns if c != text]
    return split_blocks(df, text, *rest, separator=pattern).withColumnsRenamed({"block_no": "chunk_no", "block": "chunk"})


# The messages of a batch run.
LOG_OFFERED = r"Starting batch extraction for products (\d+)–(\d+)\."
LOG_WRITTEN = r"Batch \d+ complete\. Wrote (\d+) products\."
LOG_BAD_JSON = r"Failed to parse JSON"
LOG_FAILED = r"Batch \d+ failed\. Error: (\S+)"


def batch_report(log: DataFrame, by: Sequence[str] = (), line: str = "line") -> DataFrame:
    """Batches and records offered and written, failures by cause, and the yield."""
    text = F.col(line)
    first = F.regexp_extract(text, LOG_OFFERED, 1).try_cast("long")
    last = F.regexp_extract(text, LOG_OFFERED, 2).try_cast("long")
    written = F.regexp_extract(text, LOG_WRITTEN, 1).try_cast("long")
    cause = nonempty(F.regexp_extract(text, LOG_FAILED, 1))
    report = log.groupBy(*by).agg(
        F.count(first).alias("batches"),
        F.coalesce(F.sum(last - first + 1), F.lit(0)).alias("offered"),
        F.count(written).alias("batches_written"),
        F.coalesce(F.sum(written), F.lit(0)).alias("written"),
        F.count_if(cause == "429").alias("failed_quota"),
        F.count_if(cause.isNotNull() & (cause != "429")).alias("failed_other"),
        F.count_if(text.rlike(LOG_BAD_JSON)).alias("failed_json"),
    )
    share = F.when(F.col("offered") > 0, F.round(F.col("written") / F.col("offered"), 6))
    return report.withColumn("yield", share)
