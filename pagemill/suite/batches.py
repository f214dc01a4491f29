"""Batch preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.operators import batches as B
from pagemill.operators import html as H
from pagemill.operators import ordering
from pagemill.plans import catalogue, spec_tables
from pagemill.suite import fixtures as X
from pagemill.suite.registry import query, spread_table, table

SEPARATOR = "chr(10)||chr(10)||'---PRODUCT-SEPARATOR---'||chr(10)||chr(10)"
LOG = """CASE doc_id % 6 WHEN 0 THEN concat('Starting batch extraction for products ', doc_id, '–', doc_id + n_chars, '. Appending to x.')
    WHEN 1 THEN concat('✅ Batch ', doc_id, ' complete. Wrote ', n_chars % 300, ' products.')
    WHEN 2 THEN '⚠️ Failed to parse JSON, writing raw text instead.'
    WHEN 3 THEN concat('❌ Batch ', doc_id, ' failed. Error: 429 RESOURCE_EXHAUSTED. limit: 250000')
    WHEN 4 THEN concat('❌ Batch ', doc_id, ' failed. Error: 500 INTERNAL.') ELSE '   Prompt Feedback: None' END"""


def documents(spark, sf, *columns):
    return spread_table(spark, sf, "documents", "doc_id").select(*columns)


def batch_sql(size: int) -> str:
    return f"""SELECT batch_no, count(*) AS n, md5(string_agg(text, {SEPARATOR} ORDER BY doc_id)) AS digest
    FROM (SELECT *, (row_number() OVER (ORDER BY doc_id) - 1) // {size} AS batch_no FROM documents) GROUP BY batch_no"""


@query(batch_sql(1000))
def fixed_batches(spark, sf):
    made = B.fixed_batches(documents(spark, sf, "doc_id", "text"), "text", "doc_id")
    return made.select("batch_no", "n", F.md5("batch_text").alias("digest"))


@query(batch_sql(7))
def fixed_batches_small(spark, sf):
    made = B.fixed_batches(documents(spark, sf, "doc_id", "text"), "text", "doc_id", 7)
    return made.select("batch_no", "n", F.md5("batch_text").alias("digest"))


@query(
    """SELECT batch_no, count(*) AS n, CAST(sum(l_orderkey * 10 + l_linenumber) AS BIGINT) AS total
    FROM (SELECT *, (row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1) // 500 AS batch_no FROM lineitem) GROUP BY batch_no"""
)
def numbered_lines(spark, sf):
    """Order lines by keys that are not unique, numbered in many pieces."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    numbered = ordering.with_index(lines, ["l_orderkey", "l_linenumber"], name="place", rows=5_000)
    total = F.sum(F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("total")
    return numbered.groupBy(F.floor(F.col("place") / 500).alias("batch_no")).agg(F.count("*").alias("n"), total)


@query(
    """SELECT g, batch_no, count(*) AS n, CAST(sum(o) AS BIGINT) AS total FROM (SELECT l_returnflag AS g, l_suppkey AS o,
      row_number() OVER (PARTITION BY l_returnflag ORDER BY l_suppkey) - 1 AS i FROM lineitem), (SELECT 300 AS size),
      LATERAL (SELECT i // size AS batch_no) GROUP BY g, batch_no"""
)
def packed_lines(spark, sf):
    """Order lines of one token each, packed in pieces by a supplier that many lines share: batches of 300."""
    lines = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("g"), F.col("l_suppkey").alias("o"), F.lit(1).cast("long").alias("tokens"))
    packed = B.pack_batches(lines, ["g"], "o", 301, piece_rows=2_000)
    return packed.groupBy("g", "batch_no").agg(F.count("*").alias("n"), F.sum("o").cast("long").alias("total"))


@query("SELECT doc_id, length(text) // 4 AS tokens FROM documents")
def estimate_tokens(spark, sf):
    return B.with_tokens(documents(spark, sf, "doc_id", "text")).drop("text")


def pack_sql(source: str, limit: int) -> str:
    return f"""WITH RECURSIVE k AS (
      SELECT grp, id, tokens, row_number() OVER (PARTITION BY grp ORDER BY id) AS i FROM ({source}) WHERE tokens <= {limit}),
    f AS (SELECT grp, id, i, tokens, tokens AS total, 0 AS batch_no FROM k WHERE i = 1
      UNION ALL SELECT k.grp, k.id, k.i, k.tokens,
        CASE WHEN f.total + k.tokens < {limit} THEN f.total + k.tokens ELSE k.tokens END,
        CASE WHEN f.total + k.tokens < {limit} THEN f.batch_no ELSE f.batch_no + 1 END
      FROM f JOIN k ON k.grp = f.grp AND k.i = f.i + 1)
    SELECT grp, id, tokens, CAST(batch_no AS BIGINT) AS batch_no FROM f"""


@query(pack_sql("SELECT source AS grp, doc_id AS id, length(text) // 4 AS tokens FROM documents", 800))
def pack_batches(spark, sf):
    sized = B.with_tokens(documents(spark, sf, F.col("source").alias("grp"), F.col("doc_id").alias("id"), "text")).drop("text")
    return B.pack_batches(sized, ["grp"], "id", 800)


@query(
    pack_sql(
        f"""SELECT page_id % 3 AS grp, page_id AS id,
        len(regexp_extract(html, '(?s)<nav>.*</nav>')) // 4 AS tokens FROM pages""",
        150,
    )
)
def pack_tables(spark, sf):
    """Navigation lists of the pages, taken as the blocks to pack."""
    blocks = H.extract_blocks(table(spark, sf, "pages").select("page_id", "html"), "nav")
    grouped = blocks.select((F.col("page_id") % 3).alias("grp"), F.col("page_id").alias("id"), "html")
    return spec_tables.table_batches(grouped, ["grp"], "id", 150).drop("html")


@query(
    """SELECT doc_id, md5(concat('Fields known: ', '{"lang":"', lang, '","source":"', source, '"}', chr(10), 'Text: ', text)) AS digest
    FROM documents"""
)
def build_prompts(spark, sf):
    docs = documents(spark, sf, "doc_id", "text", "lang", "source")
    made = B.build_prompts(docs, "Fields known: {known}\nText: {batch}", "text", ["lang", "source"])
    return made.select("doc_id", F.md5("prompt").alias("digest"))


@query(
    """SELECT p_partkey // 300 AS batch_no, count(*) AS n, bool_or(p_partkey = 1) AS has_first FROM part GROUP BY 1"""
)
def request_table(spark, sf):
    """Cards of the catalogue pages as numbered prompts of 300 cards."""
    blocks = H.extract_blocks(X.card_pages(spark, sf), "div", "card")
    ordered = blocks.select((F.col("page_id") * 20 + F.col("block_no") - 1).alias("seq"), "html")
    made = catalogue.request_table(ordered, "seq", "html", 300)
    return made.select("batch_no", "n", F.col("prompt").contains('/p/1"').alias("has_first"))


@query(
    """WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents),
    c AS (SELECT doc_id, w, unnest(generate_series(0, CAST(greatest(ceil((len(w) - 100) / 80), 0) AS BIGINT))) AS chunk_no FROM w WHERE len(w) > 0)
    SELECT doc_id, chunk_no, len(w[chunk_no * 80 + 1 : chunk_no * 80 + 100]) AS n_words,
      array_to_string(w[chunk_no * 80 + 1 : chunk_no * 80 + 100], ' ') AS chunk FROM c"""
)
def chunk_text(spark, sf):
    return B.chunk_text(documents(spark, sf, "doc_id", "text"), 100, 20)


@query(
    """WITH s AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '[.!?]\\s'), lambda x: trim(x, {blanks})),
      lambda x: x <> '') AS b FROM documents)
    SELECT doc_id, unnest(generate_series(1, len(b))) AS chunk_no, unnest(b) AS chunk FROM s"""
)
def chunk_by_regex(spark, sf):
    return B.chunk_by_regex(documents(spark, sf, "doc_id", "text"), r"[.!?]\s")


@query(
    """SELECT source, count(*) FILTER (doc_id % 6 = 0) AS batches,
      CAST(coalesce(sum(n_chars + 1) FILTER (doc_id % 6 = 0), 0) AS BIGINT) AS offered,
      count(*) FILTER (doc_id % 6 = 1) AS batches_written,
      CAST(coalesce(sum(n_chars % 300) FILTER (doc_id % 6 = 1), 0) AS BIGINT) AS written,
      count(*) FILTER (doc_id % 6 = 3) AS failed_quota, count(*) FILTER (doc_id % 6 = 4) AS failed_other,
      count(*) FILTER (doc_id % 6 = 2) AS failed_json,
      CASE WHEN count(*) FILTER (doc_id % 6 = 0) > 0 THEN round(coalesce(sum(n_chars % 300) FILTER (doc_id % 6 = 1), 0)::DOUBLE
        / sum(n_chars + 1) FILTER (doc_id % 6 = 0), 6) END AS yield
    FROM documents GROUP BY source"""
)
def batch_report(spark, sf):
    lines = documents(spark, sf, "source", F.expr(LOG).alias("line"))
    return B.batch_report(lines, ["source"])
