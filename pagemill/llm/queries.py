"""The operators of this subpackage as queries over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from pagemill.llm import audit, bpe, decontamination, lines, multi_index, quality, repair, shards, simhash, substrings, toxicity, vectors, warc
from pagemill.llm.labelled import held_out
from pagemill.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from pagemill.operators.ordering import null_safe_join
from pagemill.storage import scratch_path


@query()
def op1_bpe(spark, sf):
    """Every text encoded and decoded again; digests of ids and decoded text."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return done.select(
        "doc_id",
        F.floor(F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op2_simhash(spark, sf):
    """Fingerprint and group of every document."""
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query()
def op3_lines(spark, sf):
    """Every line that isn't blank, with the first line of its class."""
    found = lines.line_classes(table(spark, sf, "documents"))
    first = F.coalesce("first", F.struct(*lines.PLACE))
    return found.select(
        F.col("key").alias("doc_id"),
        "line_no",
        first["key"].alias("class_doc_id"),
        first["line_no"].alias("class_line_no"),
        lines.removable().alias("removed"),
    )


@query(
    """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.q, b.q)::BIGINT AS score
        FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0
    ),
    ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
    """
)
def op4_vectors(spark, sf):
    """The 20 best other vectors for every query vector, exactly."""
    return vectors.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0)


@query(
    """
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    digests AS (
        SELECT page_id, octet_length(encode(payload)) AS payload_bytes, sha256(payload) AS payload_digest FROM payloads
    ),
    firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM digests)
    SELECT page_id, payload_bytes, payload_digest,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM firsts
    """
)
def op5_warc(spark, sf):
    """Pages written as web archives and read back; what the records say and hold."""
    files = warc.write_pages(table(spark, sf, "pages"), scratch_path(spark, "warc"))
    found = warc.read_records(spark, files)
    digest = F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(F.col("payload_digest"))
    return found.select(
        warc.key_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        digest.alias("payload_digest"),
        "record_type",
        warc.key_of(F.col("refers_to")).alias("refers_to"),
    )


@query()
def op6_quality(spark, sf):
    """Every text scored by the compression classifier."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.learn(docs, table(spark, sf, "labels")))
    predicted = F.when(F.col("score") >= 0.3, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.cast("int").alias("predicted"))


@query()
def op7_shards(spark, sf):
    """All texts as token sequences in training order, written to binary files and read back."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    index = shards.write_shards(docs, scratch_path(spark, "shards"), ranks, public_tokenizers.PATTERN, seed=20)
    tokens = shards.read_shards(spark, index).select("slot", F.sha2("tokens", 256).alias("tokens_sha256"))
    return index.select("slot", "shard", "n_tokens", F.col("docs").alias("doc_ids")).join(tokens.hint("merge"), "slot")


@query()
def op8_toxicity(spark, sf):
    """Every text scored by the string-kernel machine."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.learn(docs, table(spark, sf, "labels")))
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.cast("int").alias("predicted"))


@query()
def op9_decontamination(spark, sf):
    """Every benchmark item found in a document, changed numbers and names included."""
    found = decontamination.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "windows", "share", "verbatim")


@query()
def op10_substrings(spark, sf):
    """Every document without the bytes that repeated strings of 400 bytes cover."""
    done = substrings.remove_repeated(table(spark, sf, "documents").select("doc_id", "text"))
    removed = F.col("n_bytes") - F.octet_length("kept")
    return done.select(
        "doc_id",
        "n_bytes",
        removed.cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query(
    r"""
    WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    worded AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM texts),
    firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
    marks AS (
        SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id
    ),
    failing AS (
        SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
            CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
            || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
            || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END
            || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
            || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
        FROM worded JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
    ),
    counts AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY part, fails),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
    orders AS (
        SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE b.l <> a.l AND c.l NOT IN (a.l, b.l) AND d.l NOT IN (a.l, b.l, c.l) AND e.l NOT IN (a.l, b.l, c.l, d.l)
    ),
    gone AS (
        SELECT part, filter_order, fails, n, good, toxic,
            CASE WHEN fails = '' THEN 6 ELSE list_min(list_transform(string_split(fails, ''), lambda f: strpos(filter_order, f))) END AS gone_at
        FROM counts, orders
    ),
    steps AS (SELECT unnest([1, 2, 3, 4, 5]) AS step),
    audit AS (
        SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
            sum(CASE WHEN gone_at > step THEN n ELSE 0 END) AS kept,
            sum(CASE WHEN gone_at = step THEN n ELSE 0 END) AS removed,
            sum(CASE WHEN gone_at < step AND contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END) AS redundant,
            sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS unique_fails,
            sum(CASE WHEN gone_at = step THEN good ELSE 0 END) AS good_lost,
            sum(CASE WHEN gone_at = step THEN toxic ELSE 0 END) AS toxic_lost
        FROM gone, steps GROUP BY part, filter_order, step
    )
    SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
        unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
    FROM audit
    """
)
def op11_filters(spark, sf):
    """What five filters remove in each of their orders, by language."""
    return audit.filter_audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query()
def op12_repair(spark, sf):
    """Conversations damaged by a hash and repaired by the cheapest edits."""
    rows = table(spark, sf, "conversations")
    fixed = repair.repair(repair.damaged(rows), copies="copies")
    digests = repair.transcript_digests(fixed.parts)
    found = null_safe_join(fixed.audits, digests, ["conv"])
    every = null_safe_join(rows.select(F.col("conv_id").alias("conv")).distinct(), found, ["conv"], "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    digest = F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    return every.select(F.col("conv").alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"), digest)


@query()
def op13_embeddings(spark, sf):
    """Links of near copies, their groups and the vector that stays."""
    return multi_index.near_copies(table(spark, sf, "embeddings"))
