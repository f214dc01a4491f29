"""Writers. All of them write in parallel, one file a partition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, schema: T.StructType, mode: str = "errorifexists") -> None:
    """CSV with the columns of the record class in their fixed order.

    Columns outside the record class are an error, found before any job runs;
    missing ones are written empty. No rows write no file.
    """
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    if extra:
        raise ValueError(f"columns outside the record class: {', '.join(extra)}")
    if df.isEmpty():
        return
    ordered = [
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    # The reader takes quoted fields over several lines; quotes are doubled as usual in CSV.
    df.select(*ordered).write.mode(mode).option("escape", '"').csv(path, header=True)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Append the records as JSON lines in UTF-8, fields without a value as null."""
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def json_arrays(df: DataFrame, record: Column, group: Sequence[str], order: str, size: int = 1000) -> DataFrame:
    """Records as JSON arrays of at most ``size`` elements, in order.

    One array over everything would be one row of unbounded size; the arrays
    of a group follow each other by ``array_no``.
    """
    from pagemill.operators.ordering import with_index

    numbered = with_index(df.select(*group, order, record.alias("record")), order, group, "index")
    numbered = numbered.withColumn("array_no", F.floor(F.col("index") / F.lit(size)))
    ordered = F.sort_array(F.collect_list(F.struct("index", "record")))
    arrays = numbered.groupBy(*group, "array_no").agg(ordered.alias("records"))
    records = F.transform("records", lambda r: r["record"])
    return arrays.select(
        *group,
        "array_no",
        F.size(records).cast("long").alias("n"),
        F.concat(F.lit("["), F.array_join(records, ","), F.lit("]")).alias("json"),
    )


# What stands before the url, between it and the body, and after the body.
MARKDOWN_STYLES = {
    "heading": ("# ", "\n\n", "\n\n---\n"),
    "banner": ("--- URL: ", " ---\n\n", "\n\n"),
}


def markdown_lines(url: Column, body: Column, style: str = "heading") -> Column:
    """A page as Markdown: url and body between the marks of the style."""
    before, between, after = MARKDOWN_STYLES[style]
    return F.concat(F.lit(before), url, F.lit(between), body, F.lit(after))


def markdown_pages(df: DataFrame, url: str = "url", body: str = "body", style: str = "heading") -> DataFrame:
    """Markdown of every page that has a body."""
    kept = df.filter(F.coalesce(F.col(body), F.lit("")) != "")
    return kept.withColumn("markdown", markdown_lines(F.col(url), F.col(body), style))


def write_markdown(
    df: DataFrame, path: str, url: str = "url", body: str = "body", style: str = "heading", mode: str = "errorifexists"
) -> None:
    """The corpus as Markdown text files; pages without a body are left out."""
    markdown_pages(df, url, body, style).select("markdown").write.mode(mode).text(path)


def write_tables(cells: DataFrame, path: str, by: Sequence[str] = (), mode: str = "errorifexists") -> None:
    """Extracted tables as CSV in long form, the cells of a table together and in order.

    Tables have different headers, so a wide file a table would need a job a
    table, and a folder a page would be millions of small files. The long form
    keeps the page, so tables of different pages cannot overwrite each other.
    ``by`` names coarse folder columns such as a site or a crawl date, and any
    other column, such as the page's address, is kept. Cells that come from
    ``table_cells`` stand together already, so nothing is shuffled.
    """
    ordered = cells.sortWithinPartitions(*by, "page_id", "table_no", "row_no", "col_no")
    ordered.write.mode(mode).partitionBy(*by).option("escape", '"').csv(path, header=True)


def write_url_list(df: DataFrame, path: str, url: str = "url", mode: str = "errorifexists") -> None:
    """One URL a line."""
    df.select(url).write.mode(mode).text(path)


def bundle_captures(
    events: DataFrame,
    url: str,
    order: str,
    request: Column,
    message: Column,
    is_message: Column,
    size: int = 500,
) -> DataFrame:
    """Capture bundles of each page: its url, network events and console messages.

    A busy page gets several bundles of at most ``size`` events, which a reader
    of the list sees as one sequence; an array without events is empty.
    """
    from pagemill.operators.ordering import with_index

    slim = events.select(
        F.col(url).alias("url"),
        F.col(order).alias("_order"),
        F.when(~is_message, request).alias("_request"),
        F.when(is_message, message).alias("_message"),
    )
    numbered = with_index(slim, "_order", ["url"], "_index")
    numbered = numbered.withColumn("bundle_no", F.floor(F.col("_index") / F.lit(size)))

    def collected(col: str) -> Column:
        pairs = F.sort_array(F.collect_list(F.when(F.col(col).isNotNull(), F.struct("_order", col))))
        return F.transform(pairs, lambda p: p[col])

    return numbered.groupBy("url", "bundle_no").agg(
        collected("_request").alias("network_requests"), collected("_message").alias("console_messages")
    )
