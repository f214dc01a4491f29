"""Extraction jobs over stored HTML: pages in, rows out.

Markup that does not nest is read with native expressions. The jobs that need
the element structure run a small helper per page in ``mapInPandas``, after
the page columns have been cut down to the key and the HTML, and write their
rows straight from the page: no shuffle.
"""

from __future__ import annotations

import html as entities
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import html as H
from pagemill.functions import text as X
from pagemill.functions import urls, variants
from pagemill.operators import markdown, markup, tables
from pagemill.operators.exploding import number_items
from pagemill.storage import spread_small

Rows = Callable[[str], Iterable[tuple]]
OUT_ROWS = 2_000


def map_pages(pages: DataFrame, rows: Rows, schema: str, html: str = "html", keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Rows of every page: ``rows`` gets the HTML and gives tuples of ``schema``."""
    keys = list(keys)
    slim = pages.select(*keys, F.coalesce(F.col(html), F.lit("")).alias("_html"))
    out = T.StructType([slim.schema[k] for k in keys] + T._parse_datatype_string(schema).fields)
    names = out.fieldNames()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pages_in = batch.itertuples(index=False, name=None)
            found = ((*page[:-1], *values) for page in pages_in for values in rows(page[-1]))
            while part := list(islice(found, OUT_ROWS)):
                yield pd.DataFrame(part, columns=names, dtype=object)

    return spread_small(slim, *keys).mapInPandas(run, out)


def extract_blocks(pages: DataFrame, tag: str, cls: str | None = None, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Outer HTML of every matching element in order, a nested match also by itself."""
    return extract_scoped(pages, "", f"{tag}.{cls}" if cls else tag, keys)


def extract_scoped(pages: DataFrame, container: str, target: str, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Outer HTML of every ``target`` below a ``container``."""
    steps = markup.selector(f"{container} {target}")

    def rows(text: str) -> Iterator[tuple]:
        found = markup.elements(text)
        for number, at in enumerate(markup.select(found, steps), start=1):
            yield number, text[found[at].start : found[at].end]

    return map_pages(pages, rows, "block_no long, html string", keys=keys)


def extract_tables_flat(pages: DataFrame, html: str = "html", keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Tables that hold no tables, numbered from 1."""
    return number_items(pages, keys, H.flat_tables(F.col(html)), "table_no", "html")


def extract_tables_all(pages: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """All tables, nested ones too, in document order."""
    return extract_blocks(pages, "table", keys=keys).withColumnRenamed("block_no", "table_no")


def strip_tags(pages: DataFrame, tags: Sequence[str] = H.CODE_TAGS, html: str = "html") -> DataFrame:
    """Drop the tags with their content, for tags that do not nest."""
    return pages.withColumn(html, H.strip_tags(F.col(html), tags))


def drop_elements(pages: DataFrame, selectors: Sequence[str], keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Drop all elements that match a selector, nested ones too."""
    wanted = [markup.selector(s) for s in selectors]

    def rows(text: str) -> Iterator[tuple]:
        found = markup.elements(text)
        gone = sorted({(found[at].start, found[at].end) for steps in wanted for at in markup.select(found, steps)})
        kept, last = [], 0
        for start, end in gone:
            if start >= last:
                kept.append(text[last:start])
            last = max(last, end)
        yield ("".join(kept) + text[last:],)

    return map_pages(pages, rows, "html string", keys=keys)


def table_cells(pages: DataFrame, container: str = "", keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Body cells in long form of every table, or of those below a container; spans filled, blank as null."""
    schema = "table_no long, row_no long, col_no long, header string, value string"
    return map_pages(pages, lambda text: tables.cells(text, container), schema, keys=keys)


def table_records(cells: DataFrame, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Rows of extracted tables as a map from header to value. A row is as wide as its table."""
    pairs = F.sort_array(F.collect_list(F.struct("col_no", "header", "value")))
    rows = cells.groupBy(*keys, "table_no", "row_no").agg(pairs.alias("_cells"))
    entries = F.transform("_cells", lambda c: F.struct(c["header"], c["value"]))
    return rows.select(*keys, "table_no", "row_no", F.map_from_entries(entries).alias("record"))


def extract_jsonld(pages: DataFrame, html: str = "html") -> DataFrame:
    """Image, price, rating and description of the first JSON-LD script; ``N/A`` where absent."""
    data = variants.parse(F.trim(F.regexp_extract(F.col(html), H.JSON_LD, 1)))
    read = pages.withColumn("_data", data)
    fields = {
        "photo": "$.image",
        "rating": "$.aggregateRating.ratingValue",
        "price": "$.offers.price",
        "description": "$.description",
    }
    return read.withColumns({n: variants.get_or_missing(F.col("_data"), p) for n, p in fields.items()}).drop("_data", html)


@dataclass(frozen=True)
class CardClasses:
    """Classes of the price and place of a product card. The defaults are fixed values."""

    price: str = "ooOxS"
    location: str = "oa6ri"


def extract_cards(blocks: DataFrame, classes: CardClasses = CardClasses(), html: str = "html") -> DataFrame:
    """Product fields of a card; null where the card has no such part. A part's text is all of its text, nested tags too."""
    steps = [markup.selector(f"span.{c}") for c in (classes.price, classes.location)]

    def rows(text: str) -> Iterator[tuple]:
        found = markup.elements(text)
        attrs = {tag: [markup.attributes(e.attrs) for e in found if e.tag == tag] for tag in ("a", "img")}
        href, title = (next((a[n] for a in attrs["a"] if n in a), None) for n in ("href", "title"))
        source = next((a.get("src") for a in attrs["img"]), None)
        parts = [markup.select(found, s)[:1] for s in steps]
        price, place = (markup.inner_text(text[found[p[0]].inner : found[p[0]].inner_end]) if p else None for p in parts)
        address = f"https:{href}" if href and href.startswith("//") else href
        yield address or None, source or None, title or None, price, place

    schema = "url string, photo string, title string, price string, location string"
    return map_pages(blocks, rows, schema, html, [c for c in blocks.columns if c != html])


@dataclass(frozen=True)
class Field:
    """``kind`` is ``text`` or ``attribute``; an empty selector means the base element itself."""

    name: str
    selector: str
    kind: str = "text"
    attribute: str | None = None


@dataclass(frozen=True)
class Schema:
    """Base selector and fields, e.g. ``nav li`` with the text and href of ``a``."""

    name: str
    base: str
    fields: tuple[Field, ...]

    @classmethod
    def from_dict(cls, spec: dict) -> Schema:
        fields = [Field(f["name"], f.get("selector", ""), f.get("type", "text"), f.get("attribute")) for f in spec["fields"]]
        return cls(spec["name"], spec["baseSelector"], tuple(fields))


def extract_schema(pages: DataFrame, schema: Schema | dict, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """One row for every base element; the output columns are known at plan time."""
    spec = Schema.from_dict(schema) if isinstance(schema, dict) else schema
    base = markup.selector(spec.base)
    fields = [(f, markup.selector(f.selector)) for f in spec.fields]

    def rows(text: str) -> Iterator[tuple]:
        found = markup.elements(text)
        for number, scope in enumerate(markup.select(found, base), start=1):
            values: list[str | None] = []
            for field, steps in fields:
                hits = markup.select(found, steps, scope) if steps else [scope]
                if not hits:
                    values.append(None)
                elif field.kind == "attribute":
                    values.append(markup.attributes(found[hits[0]].attrs).get(field.attribute or ""))
                else:
                    values.append(markup.inner_text(text[found[hits[0]].inner : found[hits[0]].inner_end]))
            yield number, *values

    columns = ", ".join(f"`{f.name}` string" for f in spec.fields)
    return map_pages(pages, rows, f"item_no long, {columns}", keys=keys)


# The attributes a lazily loaded image keeps its address in, by preference.
LAZY_ATTRIBUTES = ("data-src", "data-lazy-src", "data-original")


def extract_images(pages: DataFrame, html: str = "html", external: bool = True) -> DataFrame:
    """Images of each page, numbered from 1: the tag and the address it really loads.

    ``external=False`` drops images of other hosts.
    """
    rest = [c for c in pages.columns if c != html]
    rows = number_items(pages, rest, H.image_tags(F.col(html)), "image_no", "tag")
    rows = rows.withColumn("src", F.coalesce(*[H.attribute(F.col("tag"), a) for a in (*LAZY_ATTRIBUTES, "src")]))
    if external:
        return rows
    there = urls.host(urls.resolve(F.col("src"), F.col("url")))
    return rows.filter(there.isNull() | there.eqNullSafe(urls.host(F.col("url"))))


def fix_images(images: DataFrame, src: str = "src", base: str = "url") -> DataFrame:
    """Repair image addresses and decode embedded images.

    ``//h`` gets https, ``/p`` the host of the page. An embedded image is
    decoded to ``payload`` and addressed by a hash of its bytes, the same in
    every run; one that does not decode keeps its address.
    """
    value = F.col(src)
    data = F.when(value.startswith("data:image") & value.contains(","), F.substr(value, F.locate(",", value) + 1))
    payload = F.try_to_binary(data, F.lit("base64"))
    name = F.concat(F.lit("/images/"), F.sha2(F.col("payload"), 256), F.lit(".png"))
    fixed = (
        F.when(F.col("payload").isNotNull(), F.concat(urls.origin(F.col(base)), name))
        .when(value.startswith("//"), F.concat(F.lit("https:"), value))
        .when(value.startswith("/"), urls.resolve(value, F.col(base)))
        .otherwise(value)
    )
    return images.withColumn("payload", payload).withColumn("fixed_src", fixed)


def page_title(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("title", H.title(F.col(html)))


def page_profile(pages: DataFrame, html: str = "html") -> DataFrame:
    """Sizes and counts of each page in one pass."""
    body = F.col(html)
    cleaned = H.strip_tags(body, (*H.CODE_TAGS, *H.FRAME_TAGS), comments=True)
    return pages.withColumns(
        {
            "html_length": F.coalesce(F.length(body), F.lit(0)).cast("long"),
            "cleaned_length": F.coalesce(F.length(cleaned), F.lit(0)).cast("long"),
            "link_count": F.coalesce(F.size(H.hrefs(body)), F.lit(0)).cast("long"),
            "image_count": F.coalesce(F.size(H.image_tags(body)), F.lit(0)).cast("long"),
            "success": F.coalesce(F.length(body) > 0, F.lit(False)),
        }
    ).drop(html)


def html_to_text(pages: DataFrame, html: str = "html") -> DataFrame:
    return pages.withColumn("text", H.to_text(F.col(html))).drop(html)


def html_to_markdown(pages: DataFrame, links: bool = True, keys: Sequence[str] = ("page_id",)) -> DataFrame:
    """Markdown of each page; ``links=False`` keeps only the link texts."""
    return map_pages(pages, lambda text: [(markdown.convert(text, links),)], "markdown string", keys=keys)


def decode_all_entities(df: DataFrame, column: str) -> DataFrame:
    """Decode every named and numeric entity once.

    On raw HTML this runs before extraction and turns ``&lt;td&gt;`` into
    markup; on extracted text it only cleans the text.
    """

    @F.pandas_udf(T.StringType())
    def decode(values: pd.Series) -> pd.Series:
        return values.map(entities.unescape, na_action="ignore")

    return df.withColumn(column, decode(F.col(column)))


def filter_blocks(df: DataFrame, least: int, column: str = "block") -> DataFrame:
    """Keep blocks of at least ``least`` words."""
    return df.filter(X.word_count(F.col(column)) >= least)


# Fixed value: the marker of a result page without results.
NO_RESULTS = "No Results Found"


def flag_empty(pages: DataFrame, marker: str = NO_RESULTS, html: str = "html", into: str = "is_empty") -> DataFrame:
    """Mark pages that hold the marker. A page that was not fetched is not empty."""
    return pages.withColumn(into, F.coalesce(F.col(html).contains(marker), F.lit(False)))


def seo_checks(pages: DataFrame, html: str = "html") -> DataFrame:
    """Presence of title, description, language, canonical link and a single h1."""
    body = F.col(html)
    checks: dict[str, Column] = {
        "has_title": H.has(body, r"(?i)<title[^>]*>\s*[^<\s]"),
        "has_description": H.has(body, r'(?i)<meta\s[^>]*name="description"'),
        "has_lang": H.has(body, r'(?i)<html\s[^>]*lang="[^"]+"'),
        "has_charset": H.has(body, r"(?i)<meta\s[^>]*charset="),
        "has_canonical": H.has(body, r'(?i)<link\s[^>]*rel="canonical"'),
        "has_one_h1": F.regexp_count(body, F.lit(r"(?i)<h1\b")) == 1,
    }
    checked = pages.withColumns({n: F.coalesce(c, F.lit(False)) for n, c in checks.items()})
    passed = sum((F.col(n).cast("int") for n in checks), F.lit(0))
    return checked.withColumn("passed", passed.cast("long")).drop(html)
