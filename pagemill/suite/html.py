"""Extraction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.functions.html import CODE_TAGS, FRAME_TAGS
from pagemill.functions.text import ENTITIES, decode_entities as decode
from pagemill.operators import html as H
from pagemill.operators.links import extract_links
from pagemill.plans import catalogue, spec_tables
from pagemill.sources.readers import split_blocks
from pagemill.sources.writers import write_tables
from pagemill.storage import scratch_path
from pagemill.suite import fixtures as X
from pagemill.suite.registry import query, spread_table, table


def sql_quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_decode(expr: str) -> str:
    for entity, char in ENTITIES:
        expr = f"replace({expr}, {sql_quote(entity)}, {sql_quote(char)})"
    return expr


def sql_strip(expr: str, tags, comments: bool = False) -> str:
    patterns = [f"<{tag}(?:[\\s/][^>]*)?>.*?</{tag}\\s*>" for tag in tags] + ["<!--.*?-->"] * comments
    return f"regexp_replace({expr}, '(?is){'|'.join(patterns)}', '', 'g')"


def sql_text(expr: str) -> str:
    expr = sql_strip(expr, CODE_TAGS, comments=True)
    expr = f"regexp_replace({expr}, '(?i)<(br|/p|/li|/h[1-6]|/div|/tr|/title)\\b[^>]*>', chr(10), 'g')"
    expr = sql_decode(f"regexp_replace({expr}, '<[^>]*>', '', 'g')")
    expr = f"regexp_replace({expr}, '[ \\t\\r\\f]+', ' ', 'g')"
    return f"trim(regexp_replace({expr}, ' ?\\n[ \\n]*', chr(10), 'g'), {{blanks}})"


def sql_clean(expr: str) -> str:
    return sql_strip(expr, (*CODE_TAGS, *FRAME_TAGS), comments=True)


def pages(spark, sf, *columns):
    return spread_table(spark, sf, "pages", "page_id").select(*(columns or ("page_id", "html")))


def part_html(spark, sf, html):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("page_id"), F.expr(html).alias("html"))


@query("""SELECT page_id, CAST(1 AS BIGINT) AS block_no, regexp_extract(html, '(?s)<div class="ad">.*?</div>') AS html FROM pages""")
def extract_blocks(spark, sf):
    return H.extract_blocks(pages(spark, sf), "div", "ad")


@query(
    """SELECT page_id, unnest(generate_series(1, len(a))) AS block_no, unnest(a) AS html
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS a FROM pages)"""
)
def extract_scoped(spark, sf):
    return H.extract_scoped(pages(spark, sf), "nav", "a")


FLAT = """concat('<p>x</p><TABLE border="1"><tr><td>', p_name, '</td></tr></TABLE>\n t <table><tr><td>', p_brand, '</td></tr></table>')"""
DEEP = """concat('<p>x<table id="o"><tr><td>', p_name, '<table><tr><td>', p_brand, '</td></tr></table></td></tr></table><br>')"""


@query(
    """SELECT p_partkey AS page_id, CAST(1 AS BIGINT) AS table_no, concat('<TABLE border="1"><tr><td>', p_name, '</td></tr></TABLE>') AS html FROM part
    UNION ALL SELECT p_partkey, 2, concat('<table><tr><td>', p_brand, '</td></tr></table>') FROM part"""
)
def extract_tables_flat(spark, sf):
    return H.extract_tables_flat(part_html(spark, sf, FLAT))


@query(
    """SELECT p_partkey AS page_id, CAST(1 AS BIGINT) AS table_no, concat('<table id="o"><tr><td>', p_name, '<table><tr><td>', p_brand,
      '</td></tr></table></td></tr></table>') AS html FROM part
    UNION ALL SELECT p_partkey, 2, concat('<table><tr><td>', p_brand, '</td></tr></table>') FROM part"""
)
def extract_tables_all(spark, sf):
    return H.extract_tables_all(part_html(spark, sf, DEEP))


@query(f"SELECT page_id, {sql_strip('html', (*CODE_TAGS, *FRAME_TAGS))} AS html FROM pages")
def strip_tags(spark, sf):
    return H.strip_tags(pages(spark, sf), (*CODE_TAGS, *FRAME_TAGS))


@query(f"""SELECT page_id, regexp_replace({sql_strip('html', ('nav', 'style'))}, '(?s)<div class="ad">.*?</div>', '', 'g') AS html FROM pages""")
def drop_elements(spark, sf):
    return H.drop_elements(pages(spark, sf), ["nav", "div.ad", "style"])


@query(
    f"""SELECT page_id, CAST(1 AS BIGINT) AS table_no, row_no, CAST(col_no AS BIGINT) AS col_no, header, value FROM ({X.SPEC_CELLS_SQL})
    UNION ALL SELECT p_partkey // 8, 2, 1, 1, 'Inner', CAST(p_size AS VARCHAR) FROM part WHERE p_partkey % 16 = 3"""
)
def table_cells(spark, sf):
    return H.table_cells(X.spec_pages(spark, sf)).filter("header <> 'column_1'").withColumn("table_no", F.col("table_no") - 1)


@query(
    f"""SELECT page_id, CAST(1 AS BIGINT) AS table_no, row_no, CAST(col_no AS BIGINT) AS col_no, header, value FROM ({X.SPEC_CELLS_SQL})
    UNION ALL SELECT p_partkey // 8, 2, 1, 1, 'Inner', CAST(p_size AS VARCHAR) FROM part WHERE p_partkey % 16 = 3"""
)
def spec_cells(spark, sf):
    """Tables below the content container only, written in long form and read back."""
    path = scratch_path(spark, "tables")
    cells = spec_tables.spec_cells(X.spec_pages(spark, sf))
    write_tables(cells, path)
    return spark.read.schema(cells.schema).option("escape", '"').csv(path, header=True)


@query(
    """SELECT p_partkey // 8 AS page_id, p_partkey % 8 + 1 AS row_no, p_name AS name, p_brand AS brand,
    CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_retailprice AS VARCHAR) END AS price FROM part"""
)
def table_records(spark, sf):
    cells = spec_tables.spec_cells(X.spec_pages(spark, sf)).filter("table_no = 1")
    record = F.col("record")
    return H.table_records(cells).select(
        "page_id", "row_no", record["Item Name"].alias("name"), record["Brand"].alias("brand"), record["Item Price"].alias("price")
    )


@query(
    """SELECT p_partkey AS page_id,
    CASE WHEN p_partkey % 11 = 0 THEN 'N/A' ELSE 'https://img.example/' || p_partkey || '.jpg' END AS photo,
    CASE WHEN p_partkey % 11 = 0 THEN 'N/A' ELSE CAST(p_size AS VARCHAR) END AS rating,
    CASE WHEN p_partkey % 11 = 0 OR p_partkey % 7 = 0 THEN 'N/A' ELSE 'Rs. ' || CAST(p_retailprice AS VARCHAR) END AS price,
    CASE WHEN p_partkey % 11 = 0 THEN 'N/A' WHEN p_partkey % 5 = 0 THEN NULL ELSE p_name END AS description FROM part"""
)
def extract_jsonld(spark, sf):
    return H.extract_jsonld(X.jsonld_pages(spark, sf))


@query(
    """SELECT p_partkey, 'https://shop.example/p/' || p_partkey AS url, '//img.example/' || p_partkey || '.jpg' AS photo,
    p_name AS title, CAST(p_retailprice AS VARCHAR) AS price, p_brand AS location FROM part"""
)
def extract_cards(spark, sf):
    cards = table(spark, sf, "part").select("p_partkey", F.expr(X.card()).alias("html"))
    return H.extract_cards(cards, H.CardClasses("price", "loc"))


@query(
    """SELECT p_partkey // 20 AS page_id, p_partkey % 20 + 1 AS block_no, 'https://shop.example/p/' || p_partkey AS url,
    '//img.example/' || p_partkey || '.jpg' AS photo, CASE WHEN p_partkey % 5 = 0 THEN upper(p_name) ELSE p_name END AS title,
    CAST(p_retailprice AS VARCHAR) AS price, p_brand AS location,
    CASE WHEN p_partkey % 2 = 0 THEN p_size END AS units_sold, CAST(CASE WHEN p_partkey % 2 = 0 THEN p_size / 10 END AS DOUBLE) AS rating
    FROM part"""
)
def catalogue_products(spark, sf):
    """Catalogue pages to cards, completed by answers for every second card."""
    cards = catalogue.product_cards(X.card_pages(spark, sf), "card", H.CardClasses("price", "loc"))
    key = F.col("p_partkey")
    answers = table(spark, sf, "part").filter(key % 2 == 0).select(
        F.floor(key / 20).alias("page_id"),
        (key % 20 + 1).alias("block_no"),
        F.when(key % 5 == 0, F.upper("p_name")).otherwise(F.lit("")).alias("title"),
        F.lit(None).cast("string").alias("price"),
        F.col("p_size").alias("units_sold"),
        (F.col("p_size") / 10).alias("rating"),
    )
    loud = table(spark, sf, "part").filter((key % 2 == 1) & (key % 5 == 0)).select(
        F.floor(key / 20).alias("page_id"), (key % 20 + 1).alias("block_no"), F.upper("p_name").alias("title"),
        F.lit("").alias("price"), F.lit(None).cast("int").alias("units_sold"), F.lit(None).cast("double").alias("rating"),
    )
    return catalogue.merged_products(cards, answers.unionByName(loud))


NAV = H.Schema("nav", "nav li", (H.Field("label", "a"), H.Field("link", "a", "attribute", "href"), H.Field("missing", "em")))


@query(
    f"""SELECT page_id, item_no, {sql_decode("regexp_extract(a, '<a [^>]*>([^<]*)<', 1)")} AS label,
      {sql_decode("regexp_extract(a, 'href=\"([^\"]*)\"', 1)")} AS link, CAST(NULL AS VARCHAR) AS missing
    FROM (SELECT page_id, unnest(generate_series(1, len(a))) AS item_no, unnest(a) AS a
          FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS a FROM pages))"""
)
def extract_schema(spark, sf):
    return H.extract_schema(pages(spark, sf), NAV)


@query(
    """SELECT p_partkey AS page_id, CAST(1 AS BIGINT) AS image_no, CASE p_partkey % 4 WHEN 0 THEN 'https://img.example/' || p_partkey || '.jpg'
      WHEN 1 THEN 'https://img.example/' || p_partkey || '.jpg' WHEN 2 THEN 'https://shop.example/img/' || p_partkey || '.jpg'
      ELSE 'https://shop.example/images/' || sha256(p_name) || '.png' END AS fixed_src,
      CASE WHEN p_partkey % 4 = 3 THEN p_name END AS payload FROM part"""
)
def fix_images(spark, sf):
    fixed = H.fix_images(H.extract_images(X.lazy_images(spark, sf)))
    return fixed.select("page_id", "image_no", "fixed_src", F.col("payload").cast("string").alias("payload"))


@query("SELECT p_partkey AS page_id, CAST(1 AS BIGINT) AS image_no FROM part WHERE p_partkey % 4 IN (2, 3)")
def extract_images(spark, sf):
    """External images dropped; an embedded one belongs to the page."""
    return H.extract_images(X.lazy_images(spark, sf), external=False).select("page_id", "image_no")


@query("""SELECT page_id, coalesce(nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), ''), 'No title') AS title FROM pages""")
def page_title(spark, sf):
    return H.page_title(pages(spark, sf)).drop("html")


@query(
    f"""SELECT page_id, length(html) AS html_length, length({sql_clean('html')}) AS cleaned_length,
    len(regexp_extract_all(html, '<a\\s[^>]*?\\bhref="([^"]*)"', 1)) AS link_count,
    len(regexp_extract_all(html, '<img\\b[^>]*>')) AS image_count, length(html) > 0 AS success FROM pages"""
)
def page_profile(spark, sf):
    return H.page_profile(pages(spark, sf))


@query(f"SELECT page_id, {sql_text('html')} AS text FROM pages")
def html_to_text(spark, sf):
    return H.html_to_text(pages(spark, sf))


RICH = """concat('<html><head><title>t</title></head><body><script>var a = "<p>";</script><!-- c --><h2> ', p_name,
  ' </h2><p>Size  <b>', p_size, '</b> &amp; by <a href="/b/', p_partkey, '">', p_brand, '</a><br>next</p><ul>\n<li>', p_type,
  '</li><li>', p_retailprice, '</li></ul><table><tr><th>A</th><th>B</th></tr><tr><td>', p_name, '</td><td>', p_size, '</td></tr></table>')"""


@query(
    """SELECT p_partkey AS page_id, concat('## ', p_name, chr(10), chr(10), 'Size **', p_size, '** & by [', p_brand, '](/b/', p_partkey,
    ')', chr(10), 'next', chr(10), chr(10), '- ', p_type, chr(10), '- ', CAST(p_retailprice AS VARCHAR), chr(10), chr(10), '| A | B |',
    chr(10), '| --- | --- |', chr(10), '| ', p_name, ' | ', p_size, ' |') AS markdown FROM part"""
)
def html_to_markdown(spark, sf):
    return H.html_to_markdown(part_html(spark, sf, RICH))


@query(f"""SELECT page_id, {sql_decode("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")} AS title FROM pages""")
def decode_entities(spark, sf):
    titled = H.page_title(pages(spark, sf))
    return titled.select("page_id", F.when(F.col("title") != "No title", decode(F.col("title"))).otherwise("").alias("title"))


# A page cut off in the middle of an entity ends in ``&amp``, which the full decoder knows.
FULL_DECODE = f"regexp_replace({sql_decode('html').removeprefix('replace(').rsplit(', ', 2)[0]}, '&amp;?', '&', 'g')"


@query(f"SELECT page_id, {FULL_DECODE} AS html FROM pages")
def decode_before_parsing(spark, sf):
    """The order that decodes raw HTML first, with the full set of entities."""
    return H.decode_all_entities(pages(spark, sf), "html")


@query(
    """WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, {blanks})), lambda x: x <> '') AS b
      FROM documents), r AS (SELECT doc_id, unnest(generate_series(1, len(b))) AS block_no, unnest(b) AS block FROM s)
    SELECT doc_id, block_no, block FROM r WHERE len(list_filter(regexp_split_to_array(block, '\\s+'), lambda w: w <> '')) >= 10"""
)
def min_words(spark, sf):
    lines = split_blocks(spread_table(spark, sf, "documents", "doc_id"), "text", "doc_id", separator="\n")
    return H.filter_blocks(lines, 10)


@query("SELECT doc_id, contains(text, 'worthless') AS is_empty FROM documents")
def flag_empty(spark, sf):
    return H.flag_empty(table(spark, sf, "documents").select("doc_id", "text"), "worthless", "text").drop("text")


@query(
    """SELECT *, CAST(has_title::INT + has_description::INT + has_lang::INT + has_charset::INT + has_canonical::INT + has_one_h1::INT AS BIGINT) AS passed
    FROM (SELECT page_id, regexp_matches(html, '(?i)<title[^>]*>\\s*[^<\\s]') AS has_title,
      regexp_matches(html, '(?i)<meta\\s[^>]*name="description"') AS has_description,
      regexp_matches(html, '(?i)<html\\s[^>]*lang="[^"]+"') AS has_lang, regexp_matches(html, '(?i)<meta\\s[^>]*charset=') AS has_charset,
      regexp_matches(html, '(?i)<link\\s[^>]*rel="canonical"') AS has_canonical,
      len(regexp_extract_all(html, '(?i)<h1\\b')) = 1 AS has_one_h1 FROM pages)"""
)
def seo_checks(spark, sf):
    return H.seo_checks(pages(spark, sf))


@query("SELECT page_id, count(*) AS links FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?\\bhref=\"[^\"]*\"')) AS a FROM pages) GROUP BY page_id")
def link_counts(spark, sf):
    return extract_links(pages(spark, sf)).groupBy("page_id").agg(F.count("*").alias("links"))
