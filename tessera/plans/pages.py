"""Page queries on the driver's `pages` table.

page_bodies     X19  body = text of the <p> children of the first existing
                     container (div.atc-content, article, div.art_main); pages
                     with a <table> give the body 'table'
page_links      X18 F14  every `nav > ul > li > a` link, made absolute
article_blocks  S17 F12  one text block per page with a body
crawl_worklist  X20  every page host x 2024-01-01..2024-01-07 list URL
The first three parse HTML (pandas UDF); their oracle SQL reads the same rules
with regular expressions (valid for the driver's regular pages), and the parser
is also checked against hand-built pages in tests/test_sources.py.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import pages as P
from tessera.plans.common import tables

# Parameters of the bound queries.
BODY_RULES = [("div.atc-content", "p"), ("article", "p"), ("div.art_main", "p")]
LINK_SELECTOR = "nav > ul > li > a"
WORKLIST = ("2024-01-01", "2024-01-07", "http://{host}/xwk/{month}/{day}_1.shtml")
HOST_PATTERN = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#]+)"


def _bodies(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.extract_bodies(t.pages.select("page_id", "url", "html"), BODY_RULES, table_marker=True)


def page_bodies(spark, sf_dir):
    return _bodies(spark, sf_dir).select("page_id", "url", "title", "body")


def page_links(spark, sf_dir):
    t = tables(spark, sf_dir)
    return P.extract_links(t.pages.select("page_id", "url", "html"), LINK_SELECTOR)


def article_blocks(spark, sf_dir):
    b = _bodies(spark, sf_dir).where(F.col("body").isNotNull())
    b = b.withColumn("time", P.publication_time(F.col("url"), F.lit(None).cast("string")))
    return P.article_blocks(b.select("page_id", "title", "time", "url", "body")).select("page_id", "block")


def crawl_worklist(spark, sf_dir):
    t = tables(spark, sf_dir)
    hosts = t.pages.select(F.regexp_extract("url", HOST_PATTERN, 1).alias("host")).where(F.col("host") != "") \
        .distinct()
    start, end, template = WORKLIST
    return P.worklist(hosts, start, end, template).withColumn("day", F.date_format("day", "yyyy-MM-dd"))


QUERIES = {
    "page_bodies": page_bodies,
    "page_links": page_links,
    "article_blocks": article_blocks,
    "crawl_worklist": crawl_worklist,
}

# Oracle SQL: the same rules read with regular expressions.  The driver's
# pages hold one <article> (no div.atc-content / div.art_main container, no
# <table>), <p> items directly inside it, and no markup inside comments or
# scripts of the article, so splitting the article on '<p>' gives its items.
_ENTITIES = [("&quot;", '"'), ("&#39;", "'"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"),
             ("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")]


def _text_sql(x: str) -> str:
    """Text of a markup fragment: tags dropped, entities decoded (&amp; last).
    These are legacy entities, decoded without their `;` too (titles cut
    inside an entity end in `&amp`)."""
    out = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in _ENTITIES:
        out = f"regexp_replace({out}, '{ent[:-1]};?', '{ch.replace(chr(39), chr(39) * 2)}', 'g')"
    return out


_BODIES_SQL = f"""
WITH pg AS (
  SELECT page_id, url, html,
         regexp_matches(html, '<article>') AS has_article,
         regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS art,
         nullif(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '') AS h1,
         nullif(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1), '') AS ttl
  FROM pages),
bodies AS (
  SELECT page_id, url,
         trim({_text_sql('coalesce(h1, ttl)')}) AS title,
         CASE WHEN html LIKE '%<table%' THEN '{P.TABLE_BODY}'
              WHEN has_article THEN array_to_string(list_transform(
                   (string_split(art, '<p>'))[2:],
                   lambda s: chr(10) || {_text_sql("split_part(s, '</p>', 1)")}), '')
         END AS body
  FROM pg)"""

PAGE_BODIES_SQL = _BODIES_SQL + "\nSELECT page_id, url, title, body FROM bodies"

PAGE_LINKS_SQL = f"""
WITH nav AS (
  SELECT page_id, url, regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1) AS nav FROM pages),
l AS (
  SELECT page_id, url,
         regexp_extract_all(nav, '<li><a href="([^"]*)">(.*?)</a>', 1) AS hrefs,
         regexp_extract_all(nav, '<li><a href="([^"]*)">(.*?)</a>', 2) AS texts
  FROM nav),
x AS (
  SELECT page_id, url, unnest(hrefs) AS href, unnest(texts) AS txt,
         unnest(generate_series(0, len(hrefs) - 1)) AS pos
  FROM l)
SELECT page_id, url, pos, trim({_text_sql('txt')}) AS title,
       CASE WHEN regexp_matches({_text_sql('href')}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {_text_sql('href')}
            WHEN starts_with(href, './') THEN regexp_extract(url, '^(.*/)', 1) || substr({_text_sql('href')}, 3)
            WHEN starts_with(href, '/')
              THEN regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) || {_text_sql('href')}
            ELSE regexp_extract(url, '^(.*/)', 1) || {_text_sql('href')} END AS link_url,
       CAST(NULL AS VARCHAR) AS time
FROM x"""

ARTICLE_BLOCKS_SQL = _BODIES_SQL + f""",
dated AS (SELECT *, nullif(regexp_extract(url, '(\\d{{8}})', 1), '') AS d FROM bodies WHERE body IS NOT NULL)
SELECT page_id,
       coalesce(title, '') || chr(10)
       || coalesce(CASE WHEN starts_with(d, '20') THEN substr(d, 1, 4) || '\u5e74' END, '') || chr(10)
       || coalesce(url, '') || chr(10) || chr(10) || body || chr(10) || chr(10)
       || '{P.BLOCK_STARS}' || chr(10) || chr(10) AS block
FROM dated"""

ORACLE = {
    "page_bodies": PAGE_BODIES_SQL,
    "page_links": PAGE_LINKS_SQL,
    "article_blocks": ARTICLE_BLOCKS_SQL,
    "crawl_worklist": f"""
WITH hosts AS (SELECT DISTINCT regexp_extract(url, '{HOST_PATTERN}', 1) AS host FROM pages),
days AS (SELECT CAST(d AS DATE) AS day FROM (SELECT unnest(generate_series(DATE '{WORKLIST[0]}', DATE '{WORKLIST[1]}',
                                                                         INTERVAL 1 DAY)) AS d))
SELECT host, strftime(day, '%Y-%m-%d') AS day,
       'http://' || host || '/xwk/' || strftime(day, '%Y%m') || '/' || strftime(day, '%Y%m%d') || '_1.shtml' AS url
FROM hosts, days WHERE host <> ''""",
}
