"""Readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.functions import variants
from pagemill.functions.text import strip
from pagemill.operators.exploding import number_items
from pagemill.sources.captures import list_elements
from pagemill.sources.schemas import PAGE, STATE


def load_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE) -> DataFrame:
    """Stored pages, with a fixed schema so that no footer is read to infer one."""
    return spark.read.schema(schema).parquet(path)


# Where a line or record of a text file stands: ``file``, then the others in this order.
TEXT_PLACE = ("file", "block_start", "line_no")


def _texts(lines: DataFrame, name: str, place: bool) -> DataFrame:
    text = strip(F.col("value")).alias(name)
    if not place:
        return lines.select(text).filter(F.col(name) != "")
    # A task reads the part of a file in order; the part's start and a number that grows in the task order its lines.
    where = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block_start")]
    return lines.select(*where, F.monotonically_increasing_id().alias("line_no"), text).filter(F.col(name) != "")


def load_url_list(spark: SparkSession, path: str, place: bool = False) -> DataFrame:
    """URLs of a text file, one a line, trimmed, blank lines dropped; with ``place`` the columns of ``TEXT_PLACE`` too.

    The place orders lines within one reading; it is no line number.
    """
    return _texts(spark.read.text(path), "url", place)


def load_blocks(spark: SparkSession, path: str, place: bool = False) -> DataFrame:
    """Records separated by a blank line, with ``place`` as in :func:`load_url_list`. A large file is split by the reader."""
    return _texts(spark.read.option("lineSep", "\n\n").text(path), "block", place)


def split_blocks(df: DataFrame, text: Column | str, *keys: str, separator: str = r"\n\n") -> DataFrame:
    """Blank-line separated records of a text column, numbered from 1 in their order."""
    text = F.col(text) if isinstance(text, str) else text
    kept = F.filter(F.transform(F.split(text, separator), strip), lambda b: b != "")
    return number_items(df, keys, kept, "block_no", "block")


def flatten_captures(df: DataFrame, json: Column | str, *keys: str) -> DataFrame:
    """Network events of capture documents: one bundle or a list of bundles each.

    Entries that are no object, or whose ``network_requests`` is no list, give
    no rows; so does text that is no JSON.
    """
    json = F.col(json) if isinstance(json, str) else json
    parsed = df.select(*keys, variants.parse(json).alias("_value"))
    return _events(number_items(parsed, keys, variants.items_or_self(F.col("_value")), "bundle_no", "bundle", 0), *keys)


def _events(bundles: DataFrame, *keys: str) -> DataFrame:
    urls = bundles.withColumn("page_url", variants.get(F.col("bundle"), "$.url"))
    events = variants.get(F.col("bundle"), "$.network_requests", "array<variant>")
    return number_items(urls, [*keys, "bundle_no", "page_url"], events, "event_no", "event", 0)


def load_captures(spark: SparkSession, path: str, large: bool = False) -> DataFrame:
    """Capture files; each holds one JSON document.

    Many files of moderate size are a task's work each. With ``large`` a file
    is read in many tasks, in two passes, see :mod:`pagemill.sources.captures`; the rows are the same.
    """
    if large:
        return _events(list_elements(spark, path).withColumnsRenamed({"item_no": "bundle_no", "value": "bundle"}), "file")
    files = spark.read.text(path, wholetext=True).withColumn("file", F.col("_metadata.file_path"))
    return flatten_captures(files, "value", "file")


def load_model_output(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with raw lines in between; those land whole in ``_corrupt_record``."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(full).option("mode", "PERMISSIVE").json(path)


def load_state(spark: SparkSession, path: str, schema: T.StructType = STATE) -> DataFrame:
    """Results of an earlier run, or no rows if there was none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
