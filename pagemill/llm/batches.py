"""Arrow batches of a task, cut to a bounded number of bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pagemill.storage import cut_lineage

CHUNK_BYTES = 1 << 20


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with about ``limit`` bytes of ``column`` each.

    A single longer value is a slice by itself. An empty batch gives none.
    """
    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for row, length in enumerate(lengths):
        if held and held + length > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    yield batch.slice(start)


BLANK = re.compile(r"\s")


def pieces(text: str, size: int = CHUNK_BYTES, cut: re.Pattern[str] = BLANK) -> Iterator[str]:
    """The text in pieces of about ``size`` letters that begin where ``cut`` matches; together they are the text."""
    at = 0
    while at < len(text):
        found = cut.search(text, at + size) if at + size < len(text) else None
        end = found.start() if found else len(text)
        yield text[at:end]
        at = end


def values(batch: pa.RecordBatch, column: str) -> list:
    return batch.column(column).to_pylist()


def extended(batch: pa.RecordBatch, schema: pa.Schema, added: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with further columns, in the order of ``schema``."""
    arrays = [added[f.name] if f.name in added else batch.column(f.name) for f in schema]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema, strict=True)], schema=schema)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it, upper and lower case alike."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


MOST_TASKS = 100_000


def dealt_ranges(ranges: DataFrame, *columns: str) -> DataFrame:
    """A small table whose rows are much work each, neighbours in a task and a task for each row up to ``MOST_TASKS``."""
    stored = cut_lineage(ranges, "ranges")
    return stored.repartitionByRange(max(1, min(stored.count(), MOST_TASKS)), *columns)
