"""URL and link queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemill.functions import urls as U
from pagemill.operators import links as L
from pagemill.operators import urls as O
from pagemill.plans import site_links
from pagemill.suite.registry import query, table

# A click URL: even pages carry the volatile token.
CLICK = """CASE WHEN page_id % 2 = 0
    THEN concat(url, '___pvid--', page_id % 9, 'f-', page_id, '___scm--', page_id % 3) ELSE url END"""
SQL_HOST = "regexp_extract(lower({0}), '^[a-z]+://([^/?#:]*)', 1)"
SOCIAL = ["example.org"]
KEYWORDS = ["en", "utm", "blog", "feed", "html"]
LINKS = """links AS (
    SELECT page_id, url, unnest(generate_series(1, len(h))) AS link_no, unnest(h) AS href
    FROM (SELECT page_id, url, regexp_extract_all(html, '<a\\s[^>]*?\\bhref="([^"]*)"', 1) AS h FROM pages))"""
SQL_SCORE = "0.8 * (" + " + ".join(f"contains(lower(url), '{k}')::INT" for k in KEYWORDS) + ") / 5.0"


def pages(spark, sf, *columns):
    return table(spark, sf, "pages").select(*(columns or ("page_id", "url")))


def links(spark, sf):
    return L.extract_links(pages(spark, sf, "page_id", "url", "html"))


@query(
    f"""WITH {LINKS}, t AS (SELECT url AS src, regexp_extract(url, '^([a-z]+://[^/]*)', 1) || href AS dst FROM links),
    h AS (SELECT {SQL_HOST.format('src')} AS host, {SQL_HOST.format('dst')} AS there FROM t)
    SELECT host, count(*) AS links, count(*) FILTER (host = there) AS internal,
           count(*) FILTER (host <> there AND NOT (there = 'example.org' OR there LIKE '%.example.org')) AS external,
           count(*) FILTER (host <> there AND (there = 'example.org' OR there LIKE '%.example.org')) AS social
    FROM h GROUP BY host"""
)
def link_profile(spark, sf):
    return site_links.link_profile(pages(spark, sf, "page_id", "url", "html"), SOCIAL)


@query("SELECT page_id, url FROM pages WHERE regexp_matches(url, 'example\\.com/en/\\d+')")
def url_regex_filter(spark, sf):
    return O.filter_urls(pages(spark, sf), r"example\.com/en/\d+")


@query("SELECT page_id, url FROM pages WHERE url GLOB '*/en/*' OR url GLOB '*utm_source*' OR url GLOB '*.html'")
def url_glob_filter(spark, sf):
    return O.filter_globs(pages(spark, sf), ["*/en/*", "*utm_source*", "*.html"])


@query(
    f"""SELECT page_id, url FROM (SELECT page_id, url, {SQL_HOST.format('url')} AS h FROM pages)
    WHERE (h LIKE '%.example.com' OR h LIKE '%.example.net')
      AND NOT (h = 'blog.tionsh.example.net' OR h LIKE '%.blog.tionsh.example.net'
               OR h = 'cheap-pills.example.com' OR h LIKE '%.cheap-pills.example.com')"""
)
def domain_filter(spark, sf):
    blocked = ["blog.tionsh.example.net", "cheap-pills.example.com"]
    return O.filter_domains(pages(spark, sf), ["example.com", "example.net"], blocked)


@query(
    f"""SELECT page_id, url FROM (SELECT page_id, url, {SQL_HOST.format('url')} AS h FROM pages) p
    WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT {SQL_HOST.format('url')} AS d FROM pages WHERE contains(url, '/de/')) b
                      WHERE p.h = b.d OR p.h LIKE '%.' || b.d)"""
)
def domain_block_table(spark, sf):
    """Hosts with a German page are the block list: a list that grows with the data."""
    listed = pages(spark, sf).filter(F.col("url").contains("/de/")).select(U.host(F.col("url")).alias("domain")).distinct()
    return O.filter_domain_table(pages(spark, sf), listed)


@query(
    """SELECT event_id, content_type FROM (
      SELECT event_id, concat(CASE event_id % 3 WHEN 0 THEN upper(event_type) ELSE event_type END,
                              CASE event_id % 2 WHEN 0 THEN ' ; charset=utf-8' ELSE '' END) AS content_type FROM events)
    WHERE lower(trim(split_part(content_type, ';', 1))) IN ('click', 'view')"""
)
def content_type_filter(spark, sf):
    typed = table(spark, sf, "events").select(
        "event_id",
        F.expr("""concat(CASE event_id % 3 WHEN 0 THEN upper(event_type) ELSE event_type END,
            CASE event_id % 2 WHEN 0 THEN ' ; charset=utf-8' ELSE '' END)""").alias("content_type"),
    )
    return O.filter_content_type(typed, ["click", "View"])


@query(
    f"""SELECT page_id, url FROM (SELECT page_id, url, {SQL_HOST.format('url')} AS h FROM pages)
    WHERE h LIKE '%.example.com' AND h <> 'm.therou.example.com'
      AND (url GLOB '*/en/*' OR url GLOB '*/fr/*') AND regexp_matches(url, '^https:')"""
)
def filter_chain(spark, sf):
    chain = [
        U.in_domains(["example.com"], ["m.therou.example.com"]),
        U.matches_any_glob(["*/en/*", "*/fr/*"]),
        U.matches_regex("^https:"),
    ]
    return O.filter_chain(pages(spark, sf), chain)


@query("SELECT page_id, url FROM pages WHERE contains(url, '/es/') OR url LIKE '%#top'")
def filter_any(spark, sf):
    return O.filter_chain(pages(spark, sf), [U.matches_any_glob(["*/es/*"]), U.matches_regex("#top$")], "or")


@query(
    f"""WITH {LINKS}, p AS (SELECT page_id, url FROM pages), e AS (
      SELECT page_id, url AS src, regexp_extract(url, '^([a-z]+://[^/]*)', 1) || href AS dst FROM links
      UNION ALL SELECT a.page_id, a.url, b.url FROM p a JOIN p b ON b.page_id = a.page_id + 1),
    h AS (SELECT page_id, src, dst, {SQL_HOST.format('src')} AS s, {SQL_HOST.format('dst')} AS d FROM e)
    SELECT page_id, src, dst, CASE WHEN s = d THEN 'internal' WHEN d = 'example.org' OR d LIKE '%.example.org' THEN 'social'
           ELSE 'external' END AS link_class FROM h"""
)
def classify_links(spark, sf):
    inner = site_links.page_edges(pages(spark, sf, "page_id", "url", "html")).drop("link_no")
    here = pages(spark, sf)
    following = here.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("dst"))
    outer = here.withColumnRenamed("url", "src").join(following, "page_id")
    return L.classify_links(inner.unionByName(outer), social=SOCIAL)


@query(f"SELECT page_id, regexp_replace({CLICK}, '___pvid--[^_]+', '', 'g') AS canonical_url FROM pages")
def canonical_url(spark, sf):
    clicks = pages(spark, sf).select("page_id", F.expr(CLICK).alias("url"))
    return O.normalize_urls(clicks).select("page_id", "canonical_url")


@query(
    f"""SELECT page_id, regexp_extract(u, '___pvid--([^_]+)', 1) AS pvid, regexp_extract(u, '[?&]page=([^&#_]*)', 1) AS page_no,
    regexp_extract(u, '[?&]utm_source=([^&#_]*)', 1) AS utm FROM (SELECT page_id, {CLICK} AS u FROM pages)"""
)
def extract_param(spark, sf):
    clicks = pages(spark, sf).select("page_id", F.expr(CLICK).alias("url"))
    return clicks.select(
        "page_id",
        U.token_value(F.col("url")).alias("pvid"),
        U.token_value(F.col("url"), r"[?&]page=([^&#_]*)").alias("page_no"),
        U.token_value(F.col("url"), r"[?&]utm_source=([^&#_]*)").alias("utm"),
    )


@query(
    """SELECT page_id, url, c AS canonical_url FROM (
      SELECT page_id, url, c, row_number() OVER (PARTITION BY c ORDER BY page_id) AS rn FROM (
        SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\\?[^#]*', ''), '/+$', '') AS c
        FROM pages)) WHERE rn = 1"""
)
def dedupe_urls(spark, sf):
    return O.dedupe_urls(pages(spark, sf), "page_id", drop_query=True, drop_fragment=True, drop_slash=True)


@query(
    f"""WITH {LINKS}, v AS (SELECT page_id, link_no, url, CASE link_no % 6 WHEN 0 THEN href WHEN 1 THEN '//cdn.example.com' || href
        WHEN 2 THEN 'https://abs.example.com' || href WHEN 3 THEN substr(href, 2) WHEN 4 THEN '..' || href || '?x=1'
        ELSE '?page=' || link_no END AS href FROM links),
    b AS (SELECT *, regexp_extract(url, '^([a-z]+):', 1) AS scheme, regexp_extract(url, '^([a-z]+://[^/]*)', 1) AS root,
      regexp_replace(url, '[?#].*$', '') AS page FROM v),
    f AS (SELECT *, regexp_replace(page, '[^/]*$', '') AS folder FROM b)
    SELECT page_id, link_no, href, CASE link_no % 6 WHEN 0 THEN root || href WHEN 1 THEN scheme || ':' || href WHEN 2 THEN href
      WHEN 3 THEN folder || href WHEN 4 THEN regexp_replace(folder, '[^/]+/$', '') || substr(href, 4) ELSE page || href END AS target
    FROM f"""
)
def resolve_links(spark, sf):
    form = """CASE link_no % 6 WHEN 0 THEN href WHEN 1 THEN concat('//cdn.example.com', href)
        WHEN 2 THEN concat('https://abs.example.com', href) WHEN 3 THEN substr(href, 2)
        WHEN 4 THEN concat('..', href, '?x=1') ELSE concat('?page=', link_no) END"""
    varied = links(spark, sf).withColumn("href", F.expr(form))
    return L.resolve_links(varied).select("page_id", "link_no", "href", "target")


@query("SELECT DISTINCT url FROM pages WHERE regexp_matches(url, '/en/\\d+.*\\.html') ORDER BY url LIMIT 10")
def pick_links(spark, sf):
    return O.pick_links(pages(spark, sf), r"/en/\d+.*\.html", 10)


@query(
    """SELECT c_custkey, page_no, 'https://shop.example/' || c_custkey || '?page=' || page_no AS url
    FROM customer, (SELECT unnest(generate_series(1, 4)) AS page_no)"""
)
def page_urls(spark, sf):
    bases = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("https://shop.example/"), F.col("c_custkey")).alias("base_url")
    )
    return O.page_urls(bases, 4).drop("base_url")


@query(f"WITH {LINKS} SELECT page_id, link_no, href FROM links")
def extract_links(spark, sf):
    return links(spark, sf).drop("url")


@query(
    f"""WITH {LINKS}, t AS (SELECT DISTINCT regexp_extract(url, '^([a-z]+://[^/]*)', 1) || href AS url FROM links)
    SELECT url FROM t WHERE url NOT IN (SELECT url FROM pages)"""
)
def frontier(spark, sf):
    found = L.resolve_links(links(spark, sf)).select("target")
    return L.frontier(found, pages(spark, sf, "url"), "target")


@query(f"SELECT page_id, url, round({SQL_SCORE}, 9) AS score FROM pages")
def keyword_score(spark, sf):
    return O.score_urls(pages(spark, sf), KEYWORDS, 0.8).withColumn("score", F.round("score", 9))


@query(f"SELECT page_id, round({SQL_SCORE}, 9) AS score FROM pages WHERE {SQL_SCORE} >= 0.3")
def score_filter(spark, sf):
    scored = O.score_urls(pages(spark, sf), KEYWORDS, 0.8)
    return O.score_filter(scored, 0.3).select("page_id", F.round("score", 9).alias("score"))


@query(
    f"""WITH {LINKS}, t AS (SELECT DISTINCT page_id, regexp_extract(url, '^([a-z]+://[^/]*)', 1) || href AS target FROM links),
    s AS (SELECT page_id, target, (contains(lower(target), 'th')::INT + contains(lower(target), 'tion')::INT
      + contains(lower(target), 'er')::INT) / 3.0 AS score FROM t),
    r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, target) AS rank FROM s)
    SELECT page_id, target, round(score, 9) AS score, rank FROM r WHERE rank <= 3"""
)
def top_links(spark, sf):
    resolved = L.resolve_links(links(spark, sf))
    scored = O.score_urls(resolved, ["th", "tion", "er"], 1.0, url="target")
    return L.top_links(scored, 3).withColumn("score", F.round("score", 9))


@query(f"SELECT count(*) AS pages, round(avg({SQL_SCORE}), 9) AS mean_score FROM pages")
def mean_score(spark, sf):
    from pagemill.operators.aggregates import mean_score as mean

    return mean(O.score_urls(pages(spark, sf), KEYWORDS, 0.8)).withColumn("mean_score", F.round("mean_score", 9))
