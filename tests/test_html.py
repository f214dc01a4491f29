"""Nested and unclean HTML."""

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.operators import html as H
from pagemill.operators import markdown, markup, tables


def pages(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "page_id long, html string")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_nested_match_is_returned_by_itself(spark):
    html = '<div class="x card"><p>a<div class="card">b</div></div><div class="cardinal">c</div>'
    got = rows(H.extract_blocks(pages(spark, html, "<p>none", None), "div", "card"), "page_id", "block_no")
    assert got == [(0, 1, '<div class="x card"><p>a<div class="card">b</div></div>'), (0, 2, '<div class="card">b</div>')]


def test_code_and_comments_are_no_markup():
    text = '<script>if (a<b) x="</div><div class=q>";</script><!-- <div> --><div a="1>2">t</div>'
    found = markup.elements(text)
    assert [e.tag for e in found] == ["script", "div"]
    assert text[found[1].start : found[1].end] == '<div a="1>2">t</div>'


def test_end_tag_closes_what_is_left_open():
    found = markup.elements("<article><p><b>x<br><p>y</article><footer>z")
    assert {e.tag: e.end for e in found}["article"] == len("<article><p><b>x<br><p>y</article>")
    assert found[-1].tag == "footer" and found[-1].parent == -1


def test_cells_without_end_tags(spark):
    html = "<table><tr><th>A<th>B<tr><td>1<td>2<tr><td>3</table>"
    assert rows(H.table_cells(pages(spark, html)), "row_no", "col_no") == [
        (0, 1, 1, 1, "A", "1"),
        (0, 1, 1, 2, "B", "2"),
        (0, 1, 2, 1, "A", "3"),
        (0, 1, 2, 2, "B", None),
    ]


def test_spans_fill_and_never_overlap(spark):
    html = (
        "<table><tr><th rowspan=2>R</th><th colspan=2>N</th></tr><tr><th>x</th><th>N</th></tr>"
        "<tr><td rowspan=99>a</td><td>1</td><td>2</td></tr><tr><td colspan=2>3</td></tr></table>"
    )
    got = rows(H.table_cells(pages(spark, html)).select("row_no", "header", "value"), "row_no", "header")
    assert got == [(1, "N", "2"), (1, "N x", "1"), (1, "R", "a"), (2, "N", "3"), (2, "N x", "3"), (2, "R", "a")]


def test_repeated_headers_are_numbered():
    text = "<table><tr><th>A</th><th>A</th><th></th><th>A</th></tr><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr></table>"
    assert [c[3] for c in tables.cells(text)] == ["A", "A_2", "column_3", "A_3"]


def test_flat_regex_ends_a_parent_early(spark):
    html = "<TABLE><tr><td><table>i</table></td></tr></TABLE><table>\n2</table>"
    flat = [r[2] for r in rows(H.extract_tables_flat(pages(spark, html)), "table_no")]
    assert flat == ["<TABLE><tr><td><table>i</table>", "<table>\n2</table>"]
    assert H.extract_tables_all(pages(spark, html)).count() == 3


def test_schema_from_dict_knows_its_columns(spark):
    spec = {
        "name": "Recipes",
        "baseSelector": "li.dish",
        "fields": [
            {"name": "dish", "selector": "b.name a", "type": "text"},
            {"name": "page", "selector": "b.name a", "type": "attribute", "attribute": "href"},
        ],
    }
    html = (
        '<ul><li class="hot dish"><b class="name"><i><a href="/1?a=1&amp;b">Peas &amp; rice</a></i></b></li>'
        '<li class="dish"><b><a href="/x">no</a></b></li><li>out</li></ul>'
    )
    got = H.extract_schema(pages(spark, html), spec)
    assert got.columns == ["page_id", "item_no", "dish", "page"]
    assert rows(got, "item_no") == [(0, 1, "Peas & rice", "/1?a=1&b"), (0, 2, None, None)]


def test_headers_and_spans_of_odd_tables(spark):
    head = "<table><tr><th>A</th><th>A</th><th>A_2</th><th>A</th></tr><tr>"
    html = f'{head}<td>1</td><td colspan="²">2</td><td>3</td><td>4</td></tr></table>'
    assert [c[3] for c in tables.cells(html)] == ["A", "A_2", "A_2_2", "A_3"]
    assert H.table_records(H.table_cells(pages(spark, html))).count() == 1
    wide = '<table><tr><td colspan="100000">x</td></tr><tr><td rowspan="99999999999">y</td></tr></table>'
    assert max(c[2] for c in tables.cells(wide)) == 1000


def test_stray_end_tags_cost_nothing():
    import time

    start = time.perf_counter()
    found = markup.elements("<b>" * 8000 + "</i>" * 8000)
    assert len(found) == 8000 and time.perf_counter() - start < 1


def test_links_as_a_parser_sees_them(spark):
    from pagemill.operators.links import extract_links, link_class

    html = (
        '<!-- <a href="/no">n</a> --><script>x = \'<a href="/js">j</a>\'</script>'
        '<a data-x="1>2" href="/one">1</a><a title=\'a > b\' class=c href=/two/>2</a><a href="mailto:m@h.example">m</a>'
    )
    assert [r[2] for r in rows(extract_links(pages(spark, html)), "link_no")] == ["/one", "/two/", "mailto:m@h.example"]
    frame = spark.createDataFrame([("https://h.example/a", t) for t in ("https://h.example/b", "mailto:m@h.example", "javascript:x()", "https://o.example")], "s string, t string")
    assert [r[0] for r in frame.select(link_class(F.col("s"), F.col("t"))).collect()] == ["internal", "other", "other", "external"]


def test_cards_with_nested_spans(spark):
    html = '<div><a href="//h.example/1" title="T &amp; t"></a><img src="i.png"><span class="x ooOxS"><span>Rs.</span> 100</span></div>'
    got = H.extract_cards(pages(spark, html, None)).orderBy("page_id").collect()
    assert tuple(got[0]) == (0, "https://h.example/1", "i.png", "T & t", "Rs. 100", None)
    assert tuple(got[1]) == (1, None, None, None, None, None)


def test_names_that_only_start_alike(spark):
    html = "<nav-bar>keep</nav-bar><p>body</p><nav>x</nav>"
    assert rows(H.strip_tags(pages(spark, html), ["nav"]), "page_id") == [(0, "<nav-bar>keep</nav-bar><p>body</p>")]
    assert [e.tag for e in markup.elements("<a href=/x/>t</a>")] == ["a"] and markup.elements("<a href=/x/>t</a>")[0].inner_end == 13


def test_jsonld_keeps_missing_and_null_apart(spark):
    script = '<script type="application/ld+json"> {} </script>'
    html = script.replace("{}", '{"image":"i","aggregateRating":{},"description":null}')
    got = H.extract_jsonld(pages(spark, html, script.replace("{}", "{"), "<p>")).orderBy("page_id").collect()
    assert [got[0][c] for c in ("photo", "rating", "price", "description")] == ["i", "N/A", "N/A", None]
    assert all(got[i][c] == "N/A" for i in (1, 2) for c in ("photo", "rating", "price", "description"))


def test_failed_fetch_is_not_empty(spark):
    flagged = H.flag_empty(pages(spark, "x No Results Found y", "no results found", None)).orderBy("page_id")
    assert [r["is_empty"] for r in flagged.collect()] == [True, False, False]


def test_broken_embedded_image_keeps_its_address(spark):
    html = '<img src="data:image/png;base64,!!!"><img src=""><img alt="x">'
    frame = pages(spark, html).withColumn("url", F.lit("https://h.example/p"))
    got = H.fix_images(H.extract_images(frame)).orderBy("image_no").collect()
    assert [(r["fixed_src"], r["payload"]) for r in got] == [("data:image/png;base64,!!!", None), (None, None), (None, None)]


def test_decoding_first_turns_text_into_markup(spark):
    frame = pages(spark, "&lt;table&gt;&lt;tr&gt;&lt;td&gt;1&lt;/td&gt;&lt;/tr&gt;&lt;/table&gt;")
    assert H.extract_tables_all(frame).count() == 0
    assert H.extract_tables_all(H.decode_all_entities(frame, "html")).count() == 1


def test_drop_elements_takes_nested_ones_once(spark):
    html = '<form>a<form class="x">b</form></form><p>c<aside>d</aside>'
    assert rows(H.drop_elements(pages(spark, html), ["form", ".x", "aside"]), "page_id") == [(0, "<p>c")]


def test_markdown():
    html = "<h1>T</h1><p>a <i>b</i> <a href='/x'>c</a><ol><li>1<ul><li>n</ul><li>2</ol><img src='i.png' alt='A'>"
    assert markdown.convert(html) == "# T\n\na *b* [c](/x)\n\n1. 1\n\n  - n\n\n2. 2\n\n![A](i.png)"
    assert markdown.convert(html, links=False).split("\n")[2] == "a *b* c"


@given(st.text(alphabet="<>/=\"' abtdhr!-", max_size=80))
def test_any_text_is_read(text):
    found = markup.elements(text)
    assert all(0 <= e.start <= e.inner <= len(text) and e.start <= e.end <= len(text) for e in found)
    list(tables.cells(text))
    markdown.convert(text)


def test_jsonld_in_any_spelling(spark):
    body = '{"image": "i.png", "description": "a > b"}'
    tags = [
        "<script id='x' type='application/ld+json'>",
        '<SCRIPT data-a="1 > 0" TYPE = "Application/LD+JSON" async>',
        "<script type=application/ld+json>",
        '<script\n type=" application/ld+json " nonce="a\'b">',
    ]
    others = ['<script type="text/javascript">', '<script data-type="application/ld+json">', "<script>", '<scripts type="application/ld+json">']
    texts = [f"<p><script>var a = 1</script>{t}{body}</script ><script type='application/ld+json'>{{}}</script>" for t in tags] + [f"{t}{body}</script>" for t in others]
    got = H.extract_jsonld(pages(spark, *texts)).orderBy("page_id").collect()
    assert [r["photo"] for r in got] == ["i.png"] * len(tags) + ["N/A"] * len(others)
    assert {r["description"] for r in got[: len(tags)]} == {"a > b"}


def test_images_as_a_parser_sees_them(spark):
    html = """<!-- <img src="hidden.png"> --><script>x = '<img src="code.png">'</script><img alt="a > b" src="one.png"><image src="no.png">
    <IMG src=two.png><img alt="5" tall" src='three.png'/><img src="four.png" alt='it"s > it'>"""
    frame = spark.createDataFrame([(1, "http://a.example/", html)], "page_id long, url string, html string")
    assert [r["src"] for r in H.extract_images(frame).orderBy("image_no").collect()] == ["one.png", "two.png", "three.png", "four.png"]
    assert H.page_profile(frame).first()["image_count"] == 4
