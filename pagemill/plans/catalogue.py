"""Catalogue pages to merged product records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.operators import batches, html, records
from pagemill.storage import cut_lineage

PROMPT = (
    "Extract url, photo, title, price, units_sold, rating and location of every product record. "
    "Records are separated by '---PRODUCT-SEPARATOR---'. Answer with one JSON array; use null for a missing field.\n"
    "{batch}"
)


def product_cards(pages: DataFrame, cls: str, classes: html.CardClasses = html.CardClasses()) -> DataFrame:
    """Card fields of every product block; ``(page_id, block_no)`` stays the key throughout."""
    blocks = html.extract_blocks(pages.select("page_id", "html"), "div", cls)
    return html.extract_cards(blocks, classes)


def request_table(blocks: DataFrame, order: str, text: str = "html", size: int = batches.BATCH_SIZE) -> DataFrame:
    """Numbered prompts for the blocks; sending them is someone else's work."""
    stored = cut_lineage(blocks.select(order, text), "blocks")  # numbered in several passes, extracted once
    return batches.build_prompts(batches.fixed_batches(stored, text, order, size), PROMPT)


def answered_products(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed products of the responses that parse, and the dead letters."""
    good, bad = records.split_responses(responses)
    return records.to_product(records.explode_response(good)), bad


def merged_products(cards: DataFrame, answers: DataFrame) -> DataFrame:
    """Card fields completed by the model's answers for the same block."""
    full = cards.withColumns({"units_sold": F.lit(None).cast("int"), "rating": F.lit(None).cast("double")})
    return records.merge_records(full, answers, ["page_id", "block_no"])
