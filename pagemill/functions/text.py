"""Text expressions."""

from __future__ import annotations

import json
from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every code point that counts as white space (Spark's plain trim strips spaces only).
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# The common entities.
ENTITIES = (
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&reg;", "®"),
    ("&middot;", "·"),
    ("&hellip;", "…"),
    ("&ndash;", "–"),
    ("&mdash;", "—"),
    ("&micro;", "µ"),
    ("&euro;", "€"),
    ("&amp;", "&"),
)
_PIECE = r"(&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|&|[^&]+)"


def strip(col: Column) -> Column:
    """Trim all leading and trailing white space, line breaks included."""
    return F.btrim(col, F.lit(WHITESPACE))


def words(col: Column) -> Column:
    """Array of the white-space separated words."""
    return F.filter(F.split(col, r"\s+"), lambda w: w != "")


def word_count(col: Column) -> Column:
    return F.size(words(col))


def estimate_tokens(col: Column) -> Column:
    """Token estimate: a quarter of the code points, rounded down."""
    return F.floor(F.length(col) / F.lit(4))


@cache
def _known_entities() -> str:
    """Every named entity that ends in a semicolon, as a JSON object; the common ones come first."""
    known = dict(ENTITIES)
    for name, chars in html5.items():
        if name.endswith(";"):
            known.setdefault(f"&{name}", chars)
    return json.dumps(known)


def _numbered(entity: Column) -> Column:
    """The letter of a decimal or hexadecimal entity; null for a number that is no letter."""
    digits = F.regexp_extract(entity, "([0-9a-fA-F]+);", 1)
    hexadecimal = F.lower(F.substring(entity, 3, 1)) == "x"
    number = F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("int")
    known = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32"))


def decode_entities(col: Column) -> Column:
    """Decode numeric entities and all named ones that end in a semicolon, each once; what is none stays."""
    known = F.from_json(F.lit(_known_entities()), "map<string,string>")

    def one(piece: Column) -> Column:
        letter = F.when(piece.startswith("&#"), _numbered(piece)).when(piece.startswith("&"), F.try_element_at(known, piece))
        return F.coalesce(letter, piece)

    pieces = F.regexp_extract_all(col, F.lit(_PIECE), F.lit(1))
    return F.when(col.contains("&"), F.array_join(F.transform(pieces, one), "")).otherwise(col)


def nonempty(col: Column) -> Column:
    """The value, or null where it is the empty string."""
    return F.nullif(col, F.lit(""))


def falsy_to_null(col: Column, dtype: str) -> Column:
    """Null where the value is falsy for its type: ``""``, 0, 0.0, false or an empty array."""
    if dtype == "string":
        return F.nullif(col, F.lit(""))
    if dtype == "boolean":
        return F.nullif(col, F.lit(False))
    if dtype.startswith(("array", "map")):
        return F.when(F.size(col) > 0, col)
    return F.nullif(col, F.lit(0).cast(dtype))


def first_truthy(left: Column, right: Column, dtype: str) -> Column:
    """``left`` unless it is null or falsy, else ``right``."""
    return F.coalesce(falsy_to_null(left, dtype), right)
