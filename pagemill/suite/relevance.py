"""Relevance and similarity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.operators import relevance as R
from pagemill.operators import similarity as S
from pagemill.storage import scratch_path
from pagemill.suite.registry import query, spread_table, table

QUERY = ["The tion", "worthless", "Étion", "schung"]  # cut and lower-cased as texts are
SQL_TERMS = "list_filter(regexp_split_to_array(lower(text), '[\\s.,;:!?]+'), lambda w: w <> '')"
IN_QUERY = ", ".join(f"'{q}'" for q in ("the", "tion", "worthless", "étion", "schung"))

BM25_SQL = f"""WITH d AS (SELECT doc_id, {SQL_TERMS} AS t FROM documents),
    s AS (SELECT count(*) AS n, avg(len(t)) AS avg_len FROM d),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) WHERE term IN ({IN_QUERY}) GROUP BY doc_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    r AS (SELECT tf.doc_id, sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
      / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(t) / avg_len))) AS score
      FROM tf JOIN df USING (term) JOIN d ON d.doc_id = tf.doc_id, s GROUP BY tf.doc_id)"""


def documents(spark, sf):
    return spread_table(spark, sf, "documents", "doc_id").select("doc_id", "source", "text")


@query(f"{BM25_SQL} SELECT doc_id, round(score, 6) AS score FROM r")
def rank_pages(spark, sf):
    return R.rank_pages(documents(spark, sf), QUERY, "doc_id").withColumn("score", F.round("score", 6))


@query(f"{BM25_SQL} SELECT doc_id, round(score, 6) AS score FROM r ORDER BY r.score DESC, doc_id LIMIT 5")
def top_pages(spark, sf):
    ranked = R.rank_pages(documents(spark, sf), QUERY, "doc_id")
    return R.top_pages(ranked, "doc_id", 5).withColumn("score", F.round("score", 6))


MANY_SQL = f"""WITH d AS (SELECT doc_id, {SQL_TERMS} AS t FROM documents),
    s AS (SELECT count(*) AS n, avg(len(t)) AS avg_len FROM d),
    q AS (SELECT item_id, unnest(list_distinct({SQL_TERMS})) AS term FROM benchmark),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM d) GROUP BY doc_id, term),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    r AS (SELECT item_id, tf.doc_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE
      / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len(t) / avg_len))), 9) AS score
      FROM q JOIN tf USING (term) JOIN df USING (term) JOIN d ON d.doc_id = tf.doc_id, s GROUP BY item_id, tf.doc_id)
    SELECT item_id, doc_id, round(score, 6) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM r) WHERE rank <= 5"""


@query(MANY_SQL)
def rank_questions(spark, sf):
    """The five best documents for the text of every benchmark item, from a stored index of the documents."""
    path = scratch_path(spark, "postings")
    R.write_postings(documents(spark, sf), path, "doc_id")
    ranked = R.rank_queries(spark.read.parquet(path), table(spark, sf, "benchmark"), "item_id", "text", "doc_id", 5)
    return ranked.withColumn("score", F.round("score", 6))


ADAPTIVE_SQL = f"""WITH d AS (SELECT source, doc_id, list_distinct({SQL_TERMS}) AS w FROM documents),
    v AS (SELECT source, doc_id, unnest(w) AS word FROM d),
    f AS (SELECT source, word, min(doc_id) AS doc_id FROM v GROUP BY source, word),
    n AS (SELECT source, doc_id, count(*) AS fresh, count(*) FILTER (word IN ({IN_QUERY})) AS fresh_terms FROM f GROUP BY source, doc_id),
    p AS (SELECT d.source, d.doc_id, len(w) AS size, len(list_intersect(w, [{IN_QUERY}])) AS held,
      coalesce(fresh, 0) AS fresh, coalesce(fresh_terms, 0) AS fresh_terms FROM d LEFT JOIN n USING (source, doc_id)),
    q AS (SELECT *, row_number() OVER o AS page_no, sum(fresh_terms) OVER o AS seen FROM p WINDOW o AS (PARTITION BY source ORDER BY doc_id)),
    c AS (SELECT *, sum(CASE WHEN held > 0 THEN held / seen ELSE 0 END) OVER o AS shares,
      sum(CASE WHEN held > 0 THEN 1 ELSE 0 END) OVER o AS holders FROM q WINDOW o AS (PARTITION BY source ORDER BY doc_id)),
    m AS (SELECT source, doc_id, page_no, seen / 5.0::DOUBLE AS coverage, CASE WHEN holders > 0 THEN shares / holders ELSE 0 END AS consistency,
      CASE WHEN size > 0 THEN 1 - fresh / size::DOUBLE ELSE 1 END AS saturation FROM c),
    k AS (SELECT *, (coverage + consistency + saturation) / 3 AS confidence FROM m),
    g AS (SELECT *, confidence - coalesce(lag(confidence) OVER (PARTITION BY source ORDER BY doc_id), 0) AS gain FROM k)
    SELECT source, doc_id, page_no, round(coverage + 1e-9, 6) AS coverage, round(consistency + 1e-9, 6) AS consistency,
      round(saturation + 1e-9, 6) AS saturation, round(confidence + 1e-9, 6) AS confidence, round(gain + 1e-9, 6) AS gain,
      CASE WHEN confidence < 0.3 THEN 'insufficient' WHEN confidence < 0.6 THEN 'partial' WHEN confidence < 0.7 THEN 'good' ELSE 'excellent' END AS band,
      confidence >= 0.8 OR page_no >= 30 OR (page_no > 1 AND gain < 0.05) AS stop FROM g"""


@query(ADAPTIVE_SQL)
def adaptive_stats(spark, sf):
    """Each source as one crawl, its documents as the pages in order."""
    stats = R.adaptive_stats(documents(spark, sf), QUERY, "source", "doc_id")
    # The small addend keeps exact halves from being rounded either way.
    return stats.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("coverage", "consistency", "saturation", "confidence", "gain")})


@query(
    f"""WITH all_stats AS ({ADAPTIVE_SQL}), first_stop AS (SELECT source, min(doc_id) AS last FROM all_stats WHERE stop GROUP BY source)
    SELECT a.source, doc_id, page_no, band FROM all_stats a LEFT JOIN first_stop f ON a.source = f.source WHERE last IS NULL OR doc_id <= last"""
)
def visited_pages(spark, sf):
    docs = R.first_pages(table(spark, sf, "documents").select("doc_id", "source", "text"), "source", "doc_id")
    stats = R.adaptive_stats(docs, QUERY, "source", "doc_id")
    return R.visited_pages(stats, "source", "doc_id").select("source", "doc_id", "page_no", "band")


COSINE = "list_cosine_similarity(CAST({0}.embedding AS DOUBLE[]), CAST({1}.embedding AS DOUBLE[]))"
COVER_SQL = f"""WITH b AS (SELECT q.vec_id, max({COSINE.format('q', 'p')}) AS similarity FROM embeddings q, embeddings p
      WHERE q.label = 0 AND p.label <> 0 GROUP BY q.vec_id),
    c AS (SELECT vec_id, 1 - similarity AS distance FROM b)"""


def coverage(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return S.embedding_coverage(vectors.filter("label <> 0"), vectors.filter("label = 0"), "vec_id", radius=0.6)


@query(
    f"""{COVER_SQL} SELECT vec_id, round(distance, 6) AS distance, distance <= 0.6 AS covered,
    round(exp(-3.0 * greatest(distance - 0.6, 0)), 6) AS score FROM c"""
)
def embedding_coverage(spark, sf):
    """Vectors of label 0 as the queries, all others as the pages."""
    return coverage(spark, sf).withColumns({c: F.round(c, 6) for c in ("distance", "score")})


@query(
    f"""{COVER_SQL} SELECT count(*) AS queries, round(avg((distance <= 0.6)::INT), 6) AS coverage,
    round(avg(exp(-3.0 * greatest(distance - 0.6, 0))), 6) AS confidence, avg(exp(-3.0 * greatest(distance - 0.6, 0))) < 0.1 AS is_irrelevant FROM c"""
)
def coverage_summary(spark, sf):
    return S.coverage_summary(coverage(spark, sf)).withColumns({c: F.round(c, 6) for c in ("coverage", "confidence")})


@query(
    f"""SELECT a.vec_id, min(b.vec_id) AS duplicate_of FROM embeddings a JOIN embeddings b ON b.vec_id < a.vec_id
    WHERE {COSINE.format('a', 'b')} >= 0.4 GROUP BY a.vec_id"""
)
def near_duplicates(spark, sf):
    """At a threshold the given vectors reach; the default is 0.85."""
    return S.near_duplicates(table(spark, sf, "embeddings"), "vec_id", 0.4)


@query(
    """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    c AS (SELECT vec_id, e FROM v UNION ALL SELECT vec_id + 1000000, list_transform(e, lambda x, i: x + CASE WHEN i % 9 = vec_id % 9 THEN 0.02 ELSE 0 END) FROM v),
    u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM c)
    SELECT a.vec_id, min(b.vec_id) AS duplicate_of FROM u a JOIN u b ON b.vec_id < a.vec_id AND list_dot_product(a.e, b.e) >= 0.85 GROUP BY a.vec_id"""
)
def likely_duplicates(spark, sf):
    """The vectors and a slightly moved copy of each, by bands of random hyperplanes at the default threshold."""
    plain = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    moved = F.transform("embedding", lambda x, i: x + F.when((i + 1) % 9 == F.col("vec_id") % 9, 0.02).otherwise(0.0))
    return S.likely_duplicates(plain.unionByName(plain.select((F.col("vec_id") + 1_000_000).alias("vec_id"), moved.alias("embedding"))), "vec_id")
