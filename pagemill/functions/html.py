"""Native expressions over HTML text, for markup that does not nest."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.text import decode_entities, nonempty, strip

# Tags dropped with their content.
CODE_TAGS = ("script", "style", "svg", "noscript")
FRAME_TAGS = ("header", "nav", "footer", "aside", "form")

_VALUE = r"""("[^"]*"|'[^']*'|[^\s"'>]+)"""
# Attributes before the one that is wanted; a quoted value may hold ``>``.
_BEFORE = r"""(?:[^>"']|"[^"]*"|'[^']*')*?"""
HREF = rf"(?i)<a\s(?:{_BEFORE}\s)?href\s*=\s*{_VALUE}"
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
# Attributes of a start tag up to its end; a value in quotes may hold ``>``, quotes elsewhere are letters.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
IMG = rf"(?i)(<img(?=[\s/>]){_ATTRIBUTES}>)"
FLAT_TABLE = r"(?is)(<table.*?>.*?</table>)"
TITLE = r"(?is)<title[^>]*>(.*?)</title>"
_LD_TYPE = r"application/ld\+json"
JSON_LD = rf"""(?is)<script\s(?:{_BEFORE}\s)?type\s*=\s*(?:"\s*{_LD_TYPE}\s*"|'\s*{_LD_TYPE}\s*'|{_LD_TYPE}(?=[\s>])){_ATTRIBUTES}>(.*?)</script\s*>"""


def strip_tags(html: Column, tags: Sequence[str] = CODE_TAGS, comments: bool = False) -> Column:
    """Remove each tag with its content, in one pass. For tags that cannot contain themselves."""
    patterns = [rf"<{tag}(?=[\s/>])[^>]*>.*?</{tag}\s*>" for tag in tags] + ["<!--.*?-->"] * comments
    return F.regexp_replace(html, "(?is)" + "|".join(patterns), "")


def drop_markup(html: Column) -> Column:
    return F.regexp_replace(html, r"<[^>]*>", "")


def to_text(html: Column) -> Column:
    """Plain text: no code, comments or tags; entities decoded; blanks collapsed."""
    text = strip_tags(html, CODE_TAGS, comments=True)
    text = F.regexp_replace(text, r"(?i)<(br|/p|/li|/h[1-6]|/div|/tr|/title)\b[^>]*>", "\n")
    text = decode_entities(drop_markup(text))
    text = F.regexp_replace(text, r"[ \t\r\f]+", " ")
    return strip(F.regexp_replace(text, r" ?\n[ \n]*", "\n"))


def title(html: Column, default: str = "No title") -> Column:
    return F.coalesce(nonempty(F.regexp_extract(html, TITLE, 1)), F.lit(default))


def _unquote(value: Column) -> Column:
    """An attribute value without its quotes, entities decoded."""
    bare = F.regexp_replace(value, r"""^["']|["']$""", "")
    return F.when(bare.contains("&"), decode_entities(bare)).otherwise(bare)


def hrefs(html: Column) -> Column:
    """Addresses of the links outside code and comments, quoted in any way or not at all."""
    return F.transform(F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit(HREF), F.lit(1)), _unquote)


def image_tags(html: Column) -> Column:
    """Image tags outside code and comments."""
    return F.regexp_extract_all(F.regexp_replace(html, HIDDEN, ""), F.lit(IMG), F.lit(1))


def flat_tables(html: Column) -> Column:
    """Tables by shortest match; a nested table ends its parent early."""
    return F.regexp_extract_all(html, F.lit(FLAT_TABLE), F.lit(1))


def attribute(tag: Column, name: str) -> Column:
    """Attribute of one start tag, null where missing or empty."""
    return nonempty(_unquote(F.regexp_extract(tag, rf"(?i)\s{re.escape(name)}\s*=\s*{_VALUE}", 1)))


def first_tag(html: Column, tag: str, with_attr: str | None = None) -> Column:
    """First start tag of a kind, optionally only with an attribute; null if none."""
    need = rf"[^>]*?\s{re.escape(with_attr)}\s*=" if with_attr else ""
    return nonempty(F.regexp_extract(html, rf"(?i)(<{tag}\b{need}[^>]*>)", 1))


def first_text(html: Column, tag: str, cls: str) -> Column:
    """Text of the first ``tag`` with class token ``cls``; null if there is no such tag."""
    pattern = (
        rf"""(?is)(<{tag}\b[^>]*?\sclass\s*=\s*(["']?)(?:[^"'>]*\s)?{re.escape(cls)}(?:\s[^"'>]*)?\2(?=[\s/>])[^>]*>)(.*?)</{tag}\s*>"""
    )
    opened = F.regexp_extract(html, pattern, 1)
    return F.when(opened != "", strip(decode_entities(drop_markup(F.regexp_extract(html, pattern, 3)))))


def has(html: Column, regex: str) -> Column:
    return html.rlike(regex)
