"""Expressions over JSON text and variants; malformed text never fails a job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"


def parse(json: Column) -> Column:
    return F.try_parse_json(json)


def get(value: Column, path: str, dtype: str = "string") -> Column:
    return F.try_variant_get(value, path, dtype)


def get_or_missing(value: Column, path: str, default: str = MISSING) -> Column:
    """String at ``path``: ``default`` if the key is absent, null if its value is null."""
    found = get(value, path, "variant")
    return F.when(found.isNull(), F.lit(default)).otherwise(get(value, path))


def items(json: Column) -> Column:
    """Elements of a JSON array as ``array<variant>``; null for anything else."""
    return get(parse(json), "$", "array<variant>")


def items_or_self(value: Column) -> Column:
    """The elements of an array variant, or a single value as the only element."""
    return F.coalesce(get(value, "$", "array<variant>"), F.when(value.isNotNull(), F.array(value)))


def has_keys(json: Column, keys: Sequence[str]) -> Column:
    """The object has every key; a key with a null value counts as present."""
    wanted = F.array(*[F.lit(k) for k in keys])
    missing = F.size(F.array_except(wanted, F.json_object_keys(json)))
    return F.coalesce(missing == 0, F.lit(False))


def drop_key(json: Column, key: str) -> Column:
    """The object without ``key``, as JSON text."""
    members = get(parse(json), "$", "map<string,variant>")
    return F.to_json(F.map_filter(members, lambda k, _: k != key))
