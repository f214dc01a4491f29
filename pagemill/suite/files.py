"""Source and sink queries: written to scratch files and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import variants
from pagemill.operators import batches, urls
from pagemill.plans import network_log
from pagemill.sources import readers, writers
from pagemill.storage import scratch_path
from pagemill.suite.fixtures import NET_SQL, capture_bundles
from pagemill.suite.registry import query, table

PART = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]
)
BLOCK_BREAK = "chr(10)||chr(10)||' '||chr(10)||chr(10)"


@query("SELECT page_id, url, html FROM pages")
def load_pages(spark, sf):
    return readers.load_pages(spark, f"{sf}/pages.parquet")


@query("SELECT url FROM pages")
def load_url_list(spark, sf):
    path = scratch_path(spark, "urls")
    padded = F.concat(F.lit(" \t"), F.col("url"), F.lit(" \n\n   "))
    writers.write_url_list(table(spark, sf, "pages").select(padded.alias("url")), path)
    return readers.load_url_list(spark, path)


@query(
    f"""WITH s AS (SELECT doc_id, list_filter(list_transform(string_split(replace(text, '.'||chr(10), '.'||{BLOCK_BREAK}),
        chr(10)||chr(10)), lambda x: trim(x, {{blanks}})), lambda x: x <> '') AS b FROM documents)
    SELECT doc_id, unnest(generate_series(1, len(b))) AS block_no, unnest(b) AS block FROM s"""
)
def block_split(spark, sf):
    spread = F.replace(F.col("text"), F.lit(".\n"), F.lit(".\n\n \n\n"))
    return readers.split_blocks(table(spark, sf, "documents").select("doc_id", spread.alias("text")), "text", "doc_id")


@query(
    """SELECT url, c AS canonical_url FROM (SELECT url, c, row_number() OVER (PARTITION BY c ORDER BY page_id) AS rn FROM (
      SELECT page_id, url, regexp_replace(regexp_replace(url, '#.*$', ''), '\\?[^#]*', '') AS c FROM pages)) WHERE rn = 1"""
)
def first_listed_urls(spark, sf):
    """The first spelling of every address in a stored list, in the order of its lines."""
    path = scratch_path(spark, "urls")
    writers.write_url_list(table(spark, sf, "pages").select("page_id", "url").repartitionByRange("page_id").sortWithinPartitions("page_id"), path)
    listed = readers.load_url_list(spark, path, place=True)
    found = urls.dedupe_urls(listed, readers.TEXT_PLACE, drop_query=True, drop_fragment=True)
    return found.select("url", "canonical_url")


@query(
    """SELECT batch_no, count(*) AS n, md5(string_agg(b, chr(10)||chr(10)||'---PRODUCT-SEPARATOR---'||chr(10)||chr(10) ORDER BY doc_id)) AS digest
    FROM (SELECT doc_id, trim(text, {blanks}) AS b, (row_number() OVER (ORDER BY doc_id) - 1) // 60 AS batch_no FROM documents
      WHERE trim(text, {blanks}) <> '') GROUP BY batch_no"""
)
def batched_blocks(spark, sf):
    """Records of a stored text, written and read in many tasks, in batches of 60 in its order."""
    path = scratch_path(spark, "blocks")
    docs = table(spark, sf, "documents").select("doc_id", F.concat("text", F.lit("\n")).alias("value"))
    docs.repartitionByRange("doc_id").sortWithinPartitions("doc_id").select("value").write.text(path)
    placed = readers.load_blocks(spark, path, place=True)
    # The files are named in order of their part, and the first order column has to be a number.
    numbered = placed.withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).cast("long"))
    made = batches.fixed_batches(numbered, "block", ["part", "block_start", "line_no"], 60, piece_rows=300)
    return made.select("batch_no", "n", F.md5("batch_text").alias("digest"))


@query("SELECT trim(text, {blanks}) AS block FROM documents WHERE trim(text, {blanks}) <> ''")
def load_blocks(spark, sf):
    path = scratch_path(spark, "blocks")
    table(spark, sf, "documents").select(F.concat("text", F.lit("\n"))).write.text(path)
    return readers.load_blocks(spark, path)



@query(f"SELECT page_url, event_type, url, resource_type, json_extract_string(body, '$.k') AS k FROM ({NET_SQL}) WHERE event_type <> 'request_failed'")
def flatten_capture(spark, sf):
    """Bundles as single objects and as lists with entries that are no bundle."""
    bundles = capture_bundles(spark, sf)
    noise = F.concat(F.lit('[7, {"network_requests": 3}, '), "json", F.lit(', "x", {"url": "none"}]'))
    mixed = bundles.select("bundle_no", F.when(F.xxhash64("url") % 2 == 0, noise).otherwise(F.col("json")).alias("json"))
    broken = bundles.select("bundle_no", F.concat(F.lit("["), "json").alias("json"))
    events = network_log.typed_events(mixed.unionByName(broken), "json")
    body = variants.get(F.col("event"), "$.body.k")
    return events.select("page_url", "event_type", "url", "resource_type", body.alias("k"))


@query(f"SELECT page_url, count(*) AS events FROM ({NET_SQL}) WHERE event_type <> 'request_failed' GROUP BY page_url")
def load_captures(spark, sf):
    """Capture files, each a JSON list of bundles."""
    path = scratch_path(spark, "captures")
    bundles = capture_bundles(spark, sf).withColumn("folder", F.pmod(F.xxhash64("url", "bundle_no"), F.lit(1 << 30)))
    lists = writers.json_arrays(bundles, F.col("json"), [], "folder", 50)
    lists.select("json").write.option("maxRecordsPerFile", 1).text(path)
    return readers.load_captures(spark, path).groupBy("page_url").agg(F.count("*").alias("events"))


@query(f"SELECT page_url, count(*) AS events FROM ({NET_SQL}) WHERE event_type <> 'request_failed' GROUP BY page_url")
def split_captures(spark, sf):
    """Few large capture files, each read in many tasks."""
    path = scratch_path(spark, "captures")
    bundles = capture_bundles(spark, sf).withColumn("folder", F.pmod(F.xxhash64("url", "bundle_no"), F.lit(1 << 30)))
    lists = writers.json_arrays(bundles, F.col("json"), [], "folder", 5_000)
    lists.select("json").write.option("maxRecordsPerFile", 1).text(path)
    return readers.load_captures(spark, path, large=True).groupBy("page_url").agg(F.count("*").alias("events"))


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    writers.write_csv(table(spark, sf, "part").select(*reversed(PART.fieldNames())), path, PART)
    return spark.read.schema(PART).option("escape", '"').csv(path, header=True)


@query(
    """SELECT p_partkey, concat(p_name, ' é', chr(10), '"', p_brand, '"') AS p_name, p_retailprice FROM part
    UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part"""
)
def jsonl_roundtrip(spark, sf):
    path = scratch_path(spark, "jsonl")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice", "p_brand")
    odd = F.concat(F.col("p_name"), F.lit(' é\n"'), F.col("p_brand"), F.lit('"'))
    writers.append_jsonl(part.withColumn("p_name", odd).drop("p_brand"), path)
    writers.append_jsonl(part.drop("p_brand"), path)
    return spark.read.schema("p_partkey long, p_name string, p_retailprice double").json(path)


@query(
    """WITH n AS (SELECT *, (row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1) // 40 AS array_no FROM part)
    SELECT p_brand, array_no, count(*) AS n,
      concat('[', string_agg(concat('{"p_partkey":', p_partkey, ',"p_name":"', p_name, '"}'), ',' ORDER BY p_partkey), ']') AS json
    FROM n GROUP BY p_brand, array_no"""
)
def json_array_by_group(spark, sf):
    return writers.json_arrays(
        table(spark, sf, "part"), F.to_json(F.struct("p_partkey", "p_name")), ["p_brand"], "p_partkey", 40
    )


@query(
    """SELECT doc_id, concat('# https://docs.example/', doc_id, chr(10), chr(10), text, chr(10), chr(10), '---', chr(10)) AS markdown
    FROM documents WHERE doc_id % 10 <> 0 AND text <> ''"""
)
def markdown_export(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("https://docs.example/"), F.col("doc_id")).alias("url"),
        F.when(F.col("doc_id") % 10 != 0, F.col("text")).alias("body"),
    )
    return writers.markdown_pages(docs).select("doc_id", "markdown")


@query("SELECT page_id, concat('--- URL: ', url, ' ---', chr(10), chr(10), html, chr(10), chr(10)) AS markdown FROM pages")
def markdown_banner(spark, sf):
    return writers.markdown_pages(table(spark, sf, "pages"), body="html", style="banner").select("page_id", "markdown")


@query(
    """SELECT json_valid(line) AS is_json, count(*) AS n, min(doc_id) AS first_id FROM (
      SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN concat('raw ', doc_id, ' [{') ELSE concat('{"doc_id":', doc_id, '}') END AS line
      FROM documents) WHERE json_valid(line) GROUP BY 1
    UNION ALL SELECT false, count(*), NULL FROM documents WHERE doc_id % 3 = 0 HAVING count(*) > 0"""
)
def load_model_output(spark, sf):
    """JSON lines of the good batches with the raw lines of the bad ones in between."""
    path = scratch_path(spark, "answers")
    line = F.expr("CASE WHEN doc_id % 3 = 0 THEN concat('raw ', doc_id, ' [{') ELSE concat('{\"doc_id\":', doc_id, '}') END")
    table(spark, sf, "documents").select(line).write.text(path)
    read = readers.load_model_output(spark, path, T.StructType([T.StructField("doc_id", T.LongType())]))
    marked = read.select("doc_id", F.col("_corrupt_record").isNull().alias("is_json"))
    return marked.groupBy("is_json").agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))


@query(
    """SELECT line, count(*) AS n FROM (SELECT unnest(string_split(concat('# https://docs.example/', doc_id, chr(10), chr(10), text, chr(10), chr(10),
      '---', chr(10)), chr(10))) AS line FROM documents WHERE doc_id % 10 <> 0 AND text <> '') GROUP BY line"""
)
def markdown_files(spark, sf):
    """The lines of the Markdown files; a page without a body has none."""
    path = scratch_path(spark, "markdown")
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("https://docs.example/"), F.col("doc_id")).alias("url"),
        F.when(F.col("doc_id") % 10 != 0, F.col("text")).alias("body"),
    )
    writers.write_markdown(docs, path)
    lines = spark.read.option("lineSep", "\n").text(path).withColumnRenamed("value", "line")
    return lines.groupBy("line").agg(F.count("*").alias("n"))


@query("SELECT url, CAST(length(html) AS DOUBLE) AS score, CAST(page_id % 3 AS INTEGER) AS depth FROM pages")
def saved_state(spark, sf):
    """The results of an earlier run, and of one that has never been."""
    path = scratch_path(spark, "state")
    saved = table(spark, sf, "pages").select(
        "url", F.length("html").cast("double").alias("score"), (F.col("page_id") % 3).cast("int").alias("depth")
    )
    saved.write.parquet(path)
    return readers.load_state(spark, path).unionByName(readers.load_state(spark, scratch_path(spark, "none")))
