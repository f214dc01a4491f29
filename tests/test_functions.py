"""Literal cases of the column functions."""

from html.entities import html5

import pytest
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions import text as X
from pagemill.functions import urls as U
from pagemill.functions import variants as V


def value(spark, column, **row):
    frame = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {t}" for k, t in zip(row, ["string"] * len(row))))
    return frame.select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "href, expected",
    [
        ("//cdn.example/x", "https://cdn.example/x"),
        ("/x?y#z", "https://h.example/x?y#z"),
        ("x.html", "https://h.example/a/b/x.html"),
        ("../x/./y", "https://h.example/a/x/y"),
        ("../../../x", "https://h.example/x"),
        ("./", "https://h.example/a/b/"),
        ("?q=2", "https://h.example/a/b/c?q=2"),
        ("#top", "https://h.example/a/b/c?q=1#top"),
        ("", "https://h.example/a/b/c?q=1"),
        ("http://other.example", "http://other.example"),
        ("mailto:a@b", "mailto:a@b"),
    ],
)
def test_resolve(spark, href, expected):
    assert value(spark, U.resolve(F.col("h"), F.col("b")), h=href, b="https://h.example/a/b/c?q=1") == expected


def test_resolve_without_path(spark):
    assert value(spark, U.resolve(F.col("h"), F.col("b")), h="x", b="https://h.example") == "https://h.example/x"


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://A.Example:8080/x", "a.example"),
        ("http://user:pw@h.example?q", "h.example"),
        ("/relative", None),
        ("https://h.example/with space|pipe", "h.example"),
    ],
)
def test_host(spark, url, expected):
    assert value(spark, U.host(F.col("u")), u=url) == expected


def test_domains_block_wins_and_suffix_needs_a_dot(spark):
    keep = U.in_domains(["example.com"], ["bad.example.com"])(F.col("u"))
    assert value(spark, keep, u="http://a.example.com/") is True
    assert value(spark, keep, u="http://x.bad.example.com/") is False
    assert value(spark, keep, u="http://notexample.com/") is False


def test_globs_escape_like_wildcards(spark):
    match = U.matches_any_glob(["*a_b%c?"])(F.col("u"))
    assert value(spark, match, u="xxa_b%cd") is True
    assert value(spark, match, u="xxaXb%cd") is False


def test_chain_modes():
    with pytest.raises(ValueError):
        U.combine([], "xor")


def test_token_runs_to_the_next_underscore(spark):
    url = "https://h/c?x=abtest--___pvid--5094fc12-d1___voucherId--___scm--1007&q=watch"
    assert value(spark, U.drop_token(F.col("u")), u=url) == "https://h/c?x=abtest--___voucherId--___scm--1007&q=watch"
    assert value(spark, U.token_value(F.col("u")), u=url) == "5094fc12-d1"
    assert value(spark, U.drop_token(F.col("u")), u="https://h/c?x=___pvid--5&q=1") == "https://h/c?x="
    assert value(spark, U.token_value(F.col("u")), u="https://h/") == ""


def test_empty_token_is_kept(spark):
    assert value(spark, U.drop_token(F.col("u")), u="a___wh_pid--___type--b") == "a___wh_pid--___type--b"


def test_token_map(spark):
    assert value(spark, U.token_map(F.col("u")), u="a--1___b--___c--x")["c"] == "x"


def test_keyword_score_matches_the_known_results(spark):
    # One of five keywords at weight 0.8 gives 0.16.
    words = ["harvest", "orchard keeper", "cider", "grafting", "blossom"]
    score = U.keyword_score(F.col("u"), words, 0.8)
    assert value(spark, score, u="https://farm.example/en/Grafting/trees.html") == pytest.approx(0.16)
    assert value(spark, score, u="https://farm.example/en/prices/list.html") == 0.0


def test_entities_are_decoded_once(spark):
    text = "&#8217;&#x1F642;&#X41; &#39;&amp;#65;&amp;lt; &#0;&#xD800;&#9999999; &#65"
    assert value(spark, X.decode_entities(F.col("t")), t=text) == "’🙂A '&#65;&lt; &#0;&#xD800;&#9999999; &#65"


def test_all_named_entities_are_decoded(spark):
    names = [n for n in html5 if n.endswith(";") and n not in ("nbsp;", "amp;")]
    got = value(spark, X.decode_entities(F.col("t")), t="|".join(f"&{n}" for n in names))
    assert got == "|".join(html5[n] for n in names) and len(names) > 2_000
    text = "caf&eacute; &rarr; &nosuch; &eacute R&D &&lt;&#38;lt; &;"
    assert value(spark, X.decode_entities(F.col("t")), t=text) == "café → &nosuch; &eacute R&D &<&lt; &;"
    assert value(spark, X.decode_entities(F.col("t").cast("string")), t="") == ""


def test_strip_takes_all_white_space(spark):
    assert value(spark, X.strip(F.col("t")), t=" \n\t x y \x0b　") == "x y"


def test_tokens_count_code_points(spark):
    assert value(spark, X.estimate_tokens(F.col("t")), t="ñ" * 7) == 1


def test_entities_decode_once(spark):
    assert value(spark, X.decode_entities(F.col("t")), t="&amp;lt;&lt;&#39;") == "&lt;<'"


@pytest.mark.parametrize("model, expected", [(None, "p"), ("", "p"), ("0", "0"), ("m", "m")])
def test_first_truthy_string(spark, model, expected):
    assert value(spark, X.first_truthy(F.col("m"), F.col("p"), "string"), m=model, p="p") == expected


@pytest.mark.parametrize("dtype, falsy, truthy", [("int", 0, 3), ("double", 0.0, 0.5), ("boolean", False, True)])
def test_first_truthy_typed(spark, dtype, falsy, truthy):
    frame = spark.createDataFrame([(falsy, truthy)], f"m {dtype}, p {dtype}")
    got = frame.select(X.first_truthy(F.col("m"), F.col("p"), dtype), X.first_truthy(F.col("p"), F.col("m"), dtype)).first()
    assert list(got) == [truthy, truthy]


@pytest.mark.parametrize(
    "content_type, kept", [("text/html", True), ("Text/HTML; charset=x", True), ("text/htmlx", False), ("", False)]
)
def test_content_type(spark, content_type, kept):
    assert value(spark, U.is_content_type(["text/html"])(F.col("c")), c=content_type) is kept


def test_keys_present_with_null_value(spark):
    has = V.has_keys(F.col("j"), ["a", "b"])
    assert value(spark, has, j='{"a":null,"b":1,"c":2}') is True
    assert value(spark, has, j='{"a":1}') is False
    assert value(spark, has, j="[1]") is False
    assert value(spark, has, j="not json") is False


def test_missing_is_not_null(spark):
    parsed = V.parse(F.col("j"))
    assert value(spark, V.get_or_missing(parsed, "$.a.b"), j="{}") == "N/A"
    assert value(spark, V.get_or_missing(parsed, "$.a.b"), j='{"a":{"b":null}}') is None
    assert value(spark, V.get_or_missing(parsed, "$.a.b"), j='{"a":{"b":4.5}}') == "4.5"


def test_class_is_matched_as_a_token(spark):
    text = H.first_text(F.col("h"), "span", "price")
    assert value(spark, text, h='<span class="price-old">1</span><span class="big price"> <b>2</b>&amp;3 </span>') == "2&3"
    assert value(spark, text, h='<span class="price"></span>') == ""
    assert value(spark, text, h="<span>1</span>") is None


def test_links_in_any_quotes(spark):
    html = """<a href="/1?a=1&amp;b=2">x</a><A class='q' HREF='/2'>y</A><a data-href="/no" href=/3>z</a><a name="n">w</a><abbr href="/4">"""
    assert value(spark, H.hrefs(F.col("h")), h=html) == ["/1?a=1&b=2", "/2", "/3"]


def test_attribute_and_text_in_any_quotes(spark):
    assert value(spark, H.attribute(F.col("h"), "src"), h="<img data-src='a' src=b.png alt=c>") == "b.png"
    assert value(spark, H.first_text(F.col("h"), "span", "p"), h="<span class='x p'>1</span>") == "1"
    assert value(spark, H.first_text(F.col("h"), "span", "p"), h="<span class=p>1</span>") == "1"
