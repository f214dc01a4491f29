"""Relevance of pages to a query."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.operators.ordering import BROADCAST_BYTES, MAX_PIECES, cut_points, null_safe_join, top_per_key, with_previous, with_running_sums
from pagemill.operators.records import until_stop
from pagemill.storage import cut_lineage, plan_bytes

# Stop rules and bands of an adaptive crawl.
CONFIDENCE = 0.8
MAX_PAGES = 30
LEAST_GAIN = 0.05
BANDS = ((0.3, "insufficient"), (0.6, "partial"), (0.7, "good"))
TOP_BAND = "excellent"
DOCS_AT_ONCE = 200
PART_BYTES = 4 << 20
MATCHES_AT_ONCE = 2_000_000
SEPARATORS = r"[\s.,;:!?]+"


def terms(text: Column) -> Column:
    """Lower-cased runs between white space and punctuation."""
    return F.array_remove(F.split(F.lower(text), SEPARATORS), "")


def query_terms(query: Sequence[str]) -> list[str]:
    """The terms of a query, cut and lower-cased as those of a text."""
    return list(dict.fromkeys(t for part in query for t in re.split(SEPARATORS, part.lower()) if t))


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def rank_pages(
    docs: DataFrame, query: Sequence[str], key: str, text: str = "text", k1: float = 1.2, b: float = 0.75
) -> DataFrame:
    """Okapi BM25 score of every document that holds a query term.

    The text is read once, into a narrow table of lengths and frequencies of
    the few query terms; their statistics are one combinable row of it, read
    back as a scalar. No word is ever shuffled.
    """
    query = query_terms(query)

    def frequency(term: str) -> Column:
        return F.size(F.filter("_hits", lambda word: word == term))

    tokenized = docs.select(key, terms(F.col(text)).alias("_terms"))
    found = tokenized.select(key, F.size("_terms").alias("_length"), F.filter("_terms", lambda w: w.isin(query)).alias("_hits"))
    counts = [frequency(term).alias(f"_tf{i}") for i, term in enumerate(query)]
    counted = cut_lineage(found.select(key, "_length", *counts), "term-counts")
    stats = counted.agg(
        F.struct(
            F.count("*").alias("n"),
            F.avg("_length").alias("length"),
            *[F.count_if(F.col(f"_tf{i}") > 0).alias(f"df{i}") for i in range(len(query))],
        ).alias("stats")
    )
    hit = counted.filter(_sum([F.col(f"_tf{i}") for i in range(len(query))]) > 0)
    known = hit.withColumn("_stats", stats.scalar())
    stat = known["_stats"]

    def weight(i: int) -> Column:
        tf, df = F.col(f"_tf{i}"), stat[f"df{i}"]
        idf = F.log(1 + (stat["n"] - df + 0.5) / (df + 0.5))
        return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("_length") / stat["length"]))

    return known.select(key, _sum([weight(i) for i in range(len(query))]).alias("score"))


def postings(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``term, key, tf, length, leads``: how often every term is in every document, and how many terms that has.

    ``leads`` is true for one row of each document, which stands for it in the
    collection's statistics; a document without terms has only that row, its
    term null. Words are counted within a document, a few documents at once,
    before the only shuffle: a table of all words of a task would be as large as
    its texts. The shuffle has a part for each ``PART_BYTES`` of the texts' files.
    """
    cut = docs.select(F.col(key).alias("key"), terms(F.col(text)).alias("words")).select("key", F.size("words").alias("length"), "words")
    fields = [T.StructField("term", T.StringType()), T.StructField(key, docs.schema[key].dataType), T.StructField("tf", T.LongType())]
    schema = T.StructType([*fields, T.StructField("length", T.IntegerType()), T.StructField("leads", T.BooleanType())])
    arrow = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_AT_ONCE):
                part = batch.slice(at, DOCS_AT_ONCE)
                lists, rows, found, tf, leads = part.column("words"), [], [], [], []
                for row in range(part.num_rows):
                    held = Counter(lists[row].as_py() or ()) or {None: 0}
                    rows += [row] * len(held)
                    found += held
                    tf += held.values()
                    leads += [True] + [False] * (len(held) - 1)
                keys, lengths = (part.column(c).take(pa.array(rows, pa.int32())) for c in ("key", "length"))
                columns = [found, keys, tf, lengths, leads]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    # Documents with the same key are one.
    counted = _spread(cut.mapInArrow(count, schema), _parts(docs), "term", key)
    return counted.groupBy("term", key).agg(F.sum("tf").alias("tf"), F.max("length").alias("length"), F.max("leads").alias("leads"))


def _parts(docs: DataFrame) -> int | None:
    """Parts of a shuffle of the words of ``docs``; none if their size isn't known."""
    held = plan_bytes(docs)
    return max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(held / PART_BYTES)) if held < 1 << 50 else None


def _spread(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    return df.repartition(parts, *keys) if parts else df.repartition(*keys)


def write_postings(docs: DataFrame, path: str, key: str, text: str = "text", partitions: int | None = None) -> None:
    """Store the postings in order of the term, so that a search skips the files and row groups without its terms.

    A very common term spreads over several ranges by document.
    """
    ranged = [F.col("term"), F.col(key)]
    found, partitions = postings(docs, key, text), partitions or _parts(docs)
    dealt = found.repartitionByRange(partitions, *ranged) if partitions else found.repartitionByRange(*ranged)
    dealt.sortWithinPartitions(*ranged).write.parquet(path)


def rank_queries(
    index: DataFrame, queries: DataFrame, query: str, asked: str, key: str, top: int, k1: float = 1.2, b: float = 0.75
) -> DataFrame:
    """The ``top`` best documents of every query: ``query, key, score, rank``; ties by document.

    The stored ``index`` of :func:`write_postings` takes the place of the texts.
    Scores are those of :func:`rank_pages` to nine digits. The terms of the queries are written,
    so the planner knows their size: few are sent to the postings, many are
    joined by a shuffle in which a common term is split. Before few are sent the
    postings are dealt by document, so that a task sums up about ``MATCHES_AT_ONCE``
    matches and not those of all documents with a common term.
    """
    wanted = queries.select(query, F.explode(F.array_distinct(terms(F.col(asked)))).alias("term"))
    wanted = cut_lineage(wanted, "query-terms")
    hits = index.join(wanted.select("term").distinct(), "term", "left_semi")
    found = hits.groupBy("term").agg(F.count("*").alias("_df"))
    known = cut_lineage(wanted.join(found, "term"), "query-weights")
    lead = F.col("leads")
    stats = index.agg(F.struct(F.count_if(lead).alias("n"), F.avg(F.when(lead, F.col("length"))).alias("length")).alias("stats"))
    if plan_bytes(known) <= BROADCAST_BYTES:
        matches = known.agg(F.sum("_df")).first()[0] or 0
        index = hits.repartition(max(1, min(math.ceil(matches / MATCHES_AT_ONCE), MAX_PIECES)), key)
    matched = index.join(known, "term").withColumn("_stats", stats.scalar())
    n, mean, df, tf = F.col("_stats")["n"], F.col("_stats")["length"], F.col("_df"), F.col("tf")
    idf = F.log(1 + (n - df + 0.5) / (df + 0.5))
    part = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("length") / mean))
    # Rounded, so that the order in which a sum is taken does not decide a tie.
    scored = matched.groupBy(query, key).agg(F.round(F.sum(part), 9).alias("score"))
    return top_per_key(scored, [query], [F.desc("score"), F.asc(key)], top)


def top_pages(ranked: DataFrame, key: str, k: int = 5) -> DataFrame:
    """The ``k`` best pages; ties by key."""
    return ranked.orderBy(F.desc("score"), F.asc(key)).limit(k)


def band(confidence: Column) -> Column:
    named = F.when(confidence < BANDS[0][0], F.lit(BANDS[0][1]))
    for limit, name in BANDS[1:]:
        named = named.when(confidence < limit, F.lit(name))
    return named.otherwise(F.lit(TOP_BAND))


def adaptive_stats(
    docs: DataFrame, query: Sequence[str], crawl: str, order: str, text: str = "text", threshold: float = CONFIDENCE,
    max_pages: int = MAX_PAGES, least_gain: float = LEAST_GAIN,
) -> DataFrame:
    """Coverage, consistency, saturation and confidence after each page of each crawl.

    Coverage is the share of query terms seen so far. Saturation is one minus
    the share of the page's words that are new. Consistency is the mean, over
    the pages so far that hold any query term, of the share of the terms seen
    by then that the page holds. Confidence is the mean of the three, and gain
    what the page added to it. ``stop`` marks pages at which a rule says stop:
    enough confidence, enough pages, or, after the first page, too little gain.

    New words come from the first page of each word, a combinable minimum; the
    texts are read once for it and for the size of the pages. The rest are running sums over the crawl, taken piece by piece.
    """
    query = query_terms(query)
    pages = docs.select(crawl, order, F.array_distinct(terms(F.col(text))).alias("_words"))
    held = F.size(F.filter("_words", lambda word: word.isin(query)))
    # Measured before the explode: after it, the whole array would be measured again for each of its words.
    measured = pages.select(crawl, order, "_words", F.size("_words").alias("_size"), held.alias("_held"))
    words = measured.select(crawl, order, "_size", "_held", F.posexplode_outer("_words").alias("_at", "_word"))
    # One reading of the texts gives both the first page of each word and, on the row of a page's first word
    # (or its only row, if it has none), the page itself.
    page = F.when(F.coalesce("_at", F.lit(0)) == 0, F.col(order))
    folded = words.groupBy(crawl, "_word", page.alias("_page")).agg(
        F.min(order).alias(order), F.max("_size").alias("_size"), F.max("_held").alias("_held")
    )
    folded = cut_lineage(folded, "crawl-words")
    first = folded.filter(F.col("_word").isNotNull()).groupBy(crawl, "_word").agg(F.min(order).alias(order))
    is_query = F.col("_word").isin(query)
    new = first.groupBy(crawl, order).agg(F.count("*").alias("_new"), F.count_if(is_query).alias("_new_terms"))
    sized = folded.filter(F.col("_page").isNotNull()).select(crawl, order, "_size", "_held")
    known = null_safe_join(sized, new, [crawl, order], "left").fillna(0, ["_new", "_new_terms"])

    known = cut_lineage(known, "page-terms")
    cuts = cut_points(known, order)
    seen = {"page_no": F.lit(1).cast("long"), "_seen": F.col("_new_terms")}
    counted = with_running_sums(known, order, seen, [crawl], cuts=cuts)
    share = F.when(F.col("_held") > 0, F.col("_held") / F.col("_seen"))
    shares = {"_shares": F.coalesce(share, F.lit(0.0)), "_holders": (F.col("_held") > 0).cast("long")}
    summed = with_running_sums(counted, order, shares, [crawl], cuts=cuts)
    coverage = F.col("_seen") / F.lit(len(query))
    saturation = F.when(F.col("_size") > 0, 1 - F.col("_new") / F.col("_size")).otherwise(F.lit(1.0))
    consistency = F.when(F.col("_holders") > 0, F.col("_shares") / F.col("_holders")).otherwise(F.lit(0.0))
    scored = summed.select(
        crawl,
        order,
        "page_no",
        coverage.alias("coverage"),
        consistency.alias("consistency"),
        saturation.alias("saturation"),
        ((coverage + consistency + saturation) / 3).alias("confidence"),
    )
    gained = with_previous(scored, order, "confidence", "_previous", [crawl], cuts=cuts)
    gain = F.col("confidence") - F.coalesce(F.col("_previous"), F.lit(0.0))
    slow = (F.col("page_no") > 1) & (gain < least_gain)
    return gained.withColumns(
        {
            "gain": gain,
            "band": band(F.col("confidence")),
            "stop": (F.col("confidence") >= threshold) | (F.col("page_no") >= max_pages) | slow,
        }
    ).drop("_previous")


def first_pages(docs: DataFrame, crawl: str, order: str, max_pages: int = MAX_PAGES) -> DataFrame:
    """The first ``max_pages`` pages of each crawl, cut before any text is read: a crawl always stops by then."""
    return top_per_key(docs, [crawl], [order], max_pages, "_page").drop("_page")


def visited_pages(stats: DataFrame, crawl: str, order: str) -> DataFrame:
    """The pages of each crawl up to the first at which a rule says stop."""
    return until_stop(cut_lineage(stats, "crawl-stats"), crawl, order, F.col("stop"), with_stop=True)
