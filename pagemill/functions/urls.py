"""URL expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.text import nonempty

Predicate = Callable[[Column], Column]

# The click token that makes equal catalogue links differ, and
# the shape of a product link.
CLICK_TOKEN = r"___pvid--[^_]+"
CLICK_TOKEN_VALUE = r"___pvid--([^_]+)"
PRODUCT_LINK = r"/products/.*-i\d+.*\.html"

_ORIGIN = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
_HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def scheme(url: Column) -> Column:
    return nonempty(F.lower(F.regexp_extract(url, r"^([a-zA-Z][a-zA-Z0-9+.-]*):", 1)))


def origin(url: Column) -> Column:
    """Scheme and authority; null for a relative reference."""
    return nonempty(F.regexp_extract(url, _ORIGIN, 1))


def host(url: Column) -> Column:
    """Lower-cased host. By regex: a strict URI parser loses links with odd characters."""
    return nonempty(F.lower(F.regexp_extract(url, _HOST, 1)))


def in_domain(name: Column, domains: Iterable[str]) -> Column:
    """Host equals one of ``domains`` or is below it."""
    tests = [(name == d) | name.endswith("." + d) for d in (x.lower() for x in domains)]
    return reduce(or_, tests, F.lit(False))


def host_suffixes(name: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``: equi-join keys for a large domain list."""
    labels = F.split(name, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def glob_to_like(pattern: str) -> str:
    """``*``/``?`` glob as a LIKE pattern, so that Catalyst can simplify it."""
    escaped = re.sub(r"([%_\\])", r"\\\1", pattern)
    return escaped.replace("*", "%").replace("?", "_")


def matches_regex(regex: str) -> Predicate:
    """The URL contains a match (search, not full match)."""
    return lambda url: url.rlike(regex)


def matches_any_glob(patterns: Sequence[str]) -> Predicate:
    return lambda url: reduce(or_, [url.like(glob_to_like(p)) for p in patterns])


def in_domains(allowed: Sequence[str] = (), blocked: Sequence[str] = ()) -> Predicate:
    """Allowed unless blocked; an empty allow list allows all hosts."""

    def test(url: Column) -> Column:
        name = host(url)
        keep = in_domain(name, allowed) if allowed else F.lit(True)
        return (keep & ~F.coalesce(in_domain(name, blocked), F.lit(False))) if blocked else keep

    return test


def is_content_type(types: Sequence[str]) -> Predicate:
    """Media type equal to one of ``types``, parameters and case ignored."""
    wanted = [t.lower() for t in types]
    return lambda ct: F.lower(F.trim(F.split_part(ct, F.lit(";"), F.lit(1)))).isin(wanted)


def combine(predicates: Sequence[Predicate], mode: str = "and") -> Predicate:
    """One predicate out of many, so that the whole chain can be pushed down."""
    if mode not in ("and", "or"):
        raise ValueError(f"mode must be 'and' or 'or', not {mode!r}")
    join = and_ if mode == "and" else or_
    return lambda col: reduce(join, [p(col) for p in predicates])


def drop_token(url: Column, token: str = CLICK_TOKEN) -> Column:
    """Delete the volatile token; its value runs to the next underscore."""
    return F.regexp_replace(url, token, "")


def token_value(url: Column, pattern: str = CLICK_TOKEN_VALUE) -> Column:
    """First group of the pattern, the empty string where it does not occur."""
    return F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))


def token_map(params: Column) -> Column:
    """``k--v___k--v`` as a map."""
    return F.str_to_map(params, F.lit("___"), F.lit("--"))


def canonical(
    url: Column,
    tokens: Sequence[str] = (CLICK_TOKEN,),
    drop_query: bool = False,
    drop_fragment: bool = False,
    drop_slash: bool = False,
) -> Column:
    """Comparison form of a URL. The scheme is kept."""
    for token in tokens:
        url = drop_token(url, token)
    if drop_fragment:
        url = F.regexp_replace(url, r"#.*$", "")
    if drop_query:
        url = F.regexp_replace(url, r"\?[^#]*", "")
    if drop_slash:
        url = F.regexp_replace(url, r"/+$", "")
    return url


def _remove_dots(path: Column) -> Column:
    def step(kept: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))))
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    folded = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    plain = F.array_join(folded, "/")
    trailing = path.rlike(r"/\.{1,2}$")
    return F.when(path.rlike(r"(^|/)\.{1,2}(/|$)"), F.when(trailing, F.concat(plain, F.lit("/"))).otherwise(plain)).otherwise(path)


def resolve(href: Column, base: Column) -> Column:
    """Absolute form of ``href`` on a page at ``base``."""
    root = origin(base)
    page = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substr(page, F.length(root) + 1)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    rel_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rel_tail = F.substr(href, F.length(rel_path) + 1)
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, _remove_dots(rel_path), rel_tail))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .when(href.startswith("?"), F.concat(page, href))
        .otherwise(F.concat(root, _remove_dots(F.concat(folder, rel_path)), rel_tail))
    )


def keyword_score(url: Column, keywords: Sequence[str], weight: float = 1.0) -> Column:
    """``weight`` times the share of ``keywords`` found in the lower-cased URL."""
    lowered = F.lower(url)
    hits = reduce(lambda a, b: a + b, [lowered.contains(k.lower()).cast("int") for k in keywords])
    return F.lit(float(weight)) * hits / F.lit(float(len(keywords)))
