"""Documents with every odd case the operators have a rule for."""

from pyspark.sql import functions as F

LONG = "A sentence of the long text number %d stands here. "
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog.\nAnd a second line of some length stands here."),
    (2, "The quick brown fox jumps over the lazy dog.\nAnd a second line of some length stands here!"),
    (2, "The quick brown fox jumps over the lazy dog.\nAnd a second line of some length stands here!"),
    (3, None),
    (4, ""),
    (5, " \t\r\n\x0b\f"),
    (6, "".join(LONG % i for i in range(4000))),
    (7, "x" * 50_000),
    (8, "Ünïcödé Σ İ 漢字 🙂 á <|endoftext|> it's 12.5 km"),
    (None, "A text without a key, long enough to be one line."),
    (None, None),
    (9, "word"),
]
# Names that operators use inside or add.
CLASHING = "key text_hash line_no first last gone score fingerprint component_id token_ids decoded spans kept n_bytes hash at slots toxicity".split()


def corner_docs(spark):
    docs = spark.createDataFrame([(*t, "en", None) for t in TEXTS], "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({c: F.lit(f"own {c}") for c in CLASHING})


def no_docs(spark):
    return corner_docs(spark).limit(0)


def counted(rows):
    """Rows in any order, as often as they occur."""
    return sorted(map(repr, rows))
