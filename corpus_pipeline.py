"""A corpus made ready for training: stages over ``documents``, each one of the package's operators.

Toxic documents go, repeated lines go, of near copies the first one stays,
documents with benchmark items go, and what is left becomes token ids. Null
texts stay null until the last stage, which takes them as empty; rows are never
dropped for being empty, but all empty texts are near copies of each other.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import bpe, decontamination, lines, simhash, toxicity
from pagemill.llm.batches import free_name
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

TOXIC_FROM = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the string-kernel machine doesn't take for toxic."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = free_name(docs.columns, "toxicity")
    return toxicity.score(docs, model, name=name).filter(F.col(name) < TOXIC_FROM).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that an earlier line equals or is close to; ``n_chars`` follows the text."""
    kept = lines.drop_repeated_lines(docs)
    if "n_chars" in docs.columns:
        length = F.coalesce(F.length("text"), F.col("n_chars"))
        kept = kept.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return kept


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document that is left, and the digest of the text they decode to."""
    done = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    ids = F.floor(F.octet_length("token_ids") / 4).cast("long")
    return done.select("doc_id", ids.alias("n_tokens"), "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding and decoding", encode),
]

# No SQL: a string kernel, hashes of shingles and byte-pair merges cannot be written in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
