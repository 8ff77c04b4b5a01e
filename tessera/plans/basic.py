"""Key counts, calendars and health checks bound to the driver tables.

key_count        A1  keys = first character of every word of documents.text
key_count_parts  T7  the same counts with the reference's reducer number (13 parts), sorted per part
numeric_terms    P7  document terms that parse as numbers, with their doc count
half_day_counts  X3 F16  events per half-day publication period
partition_health X1 S5   days 2024-01-01..2024-02-05 x events per day
hour_worklist    X2      every hour between the first and last event, with counts
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import NUMBER_PATTERN, TOKEN_SPLIT, is_number, tokens
from tessera.operators import calendar as cal
from tessera.operators.keycount import key_count as _key_count, key_count_parts as _parts
from tessera.plans.common import tables

HEALTH_START, HEALTH_END = "20240101", "20240205"


def _word_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    return t.documents.select(F.explode(tokens(F.col("text"), lower=False)).alias("key"))


def key_count(spark, sf_dir):
    return _key_count(_word_keys(spark, sf_dir))


def key_count_parts(spark, sf_dir):
    return _parts(_key_count(_word_keys(spark, sf_dir)), 13)


def numeric_terms(spark, sf_dir):
    t = tables(spark, sf_dir)
    pairs = t.documents.select("doc_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term"))
    return (pairs.where(is_number(F.col("term")))
                 .groupBy("term").agg(F.count(F.lit(1)).alias("n_docs")))


def half_day_counts(spark, sf_dir):
    t = tables(spark, sf_dir)
    tagged = cal.half_day_periods(t.events.select("ts"), "ts")
    return tagged.groupBy("period_end", "am").agg(F.count(F.lit(1)).alias("n_events"))


def half_day_overlap(spark, sf_dir):
    """F16: rows per period when a job also re-reads the 40 minutes (the daily
    job) or the hour (the news index) before the period's start."""
    t = tables(spark, sf_dir)
    def per(seconds, name):
        tagged = cal.periods_with_overlap(t.events.select("ts"), "ts", seconds)
        return tagged.groupBy("period_end", "am").agg(F.count(F.lit(1)).alias(name))
    return (per(2400, "n_40_minutes").join(per(3600, "n_one_hour"), ["period_end", "am"], "full_outer")
            .na.fill(0, ["n_40_minutes", "n_one_hour"]))


def page_worklist(spark, sf_dir):
    """List-page addresses of every day that has events, pages 1 to 5."""
    t = tables(spark, sf_dir)
    days = t.events.select(F.to_date("ts").alias("day")).where("day is not null").distinct()
    return cal.url_worklist(days, "http://news.example.com/{date}/index_{page}.html", 1, 5) \
        .select(F.date_format("day", "yyyyMMdd").alias("day"), "page", "url")


def partition_health(spark, sf_dir):
    t = tables(spark, sf_dir)
    expected = cal.days(spark, HEALTH_START, HEALTH_END)
    observed = t.events.select(F.to_date("ts").alias("day"), F.octet_length("props").alias("bytes"))
    out = cal.partition_health(expected, observed, "day")
    return out.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def hour_worklist(spark, sf_dir):
    t = tables(spark, sf_dir)
    ev = t.events.select("ts")
    bounds = ev.agg(F.min("ts").alias("start"), F.max("ts").alias("end"))
    work = cal.hours_between(bounds)
    per_hour = ev.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n_events"))
    return (work.join(per_hour, "hour", "left")
                .select("hour_key", F.coalesce("n_events", F.lit(0)).alias("n_events")))


def _tok(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '{TOKEN_SPLIT}'), lambda t: t <> '')"

QUERIES = {
    "key_count": key_count,
    "key_count_parts": key_count_parts,
    "numeric_terms": numeric_terms,
    "half_day_counts": half_day_counts,
    "half_day_overlap": half_day_overlap,
    "page_worklist": page_worklist,
    "partition_health": partition_health,
    "hour_worklist": hour_worklist,
}

_PERIOD_MACRO = """CASE WHEN CAST({0} AS TIME) <= TIME '09:00:00' THEN CAST({0} AS DATE) + INTERVAL 9 HOUR
            WHEN CAST({0} AS TIME) <= TIME '17:30:00' THEN CAST({0} AS DATE) + INTERVAL 17 HOUR + INTERVAL 30 MINUTE
            ELSE CAST({0} AS DATE) + INTERVAL 1 DAY + INTERVAL 9 HOUR END"""


def _overlap_sql(seconds: int) -> str:
    """Rows (period_end) of the periods that re-read `seconds` before their start."""
    own, late = _PERIOD_MACRO.format("ts"), _PERIOD_MACRO.format(f"(ts + INTERVAL {seconds} SECOND)")
    return (f"SELECT own AS period_end FROM (SELECT {own} AS own, {late} AS late FROM events) "
            f"UNION ALL SELECT late FROM (SELECT {own} AS own, {late} AS late FROM events) WHERE late <> own")


ORACLE = {
    "half_day_overlap": f"""
WITH a AS (SELECT period_end, count(*) AS n FROM ({_overlap_sql(2400)}) GROUP BY 1),
     b AS (SELECT period_end, count(*) AS n FROM ({_overlap_sql(3600)}) GROUP BY 1)
SELECT period_end, CAST(period_end AS TIME) = TIME '09:00:00' AS am, coalesce(a.n, 0) AS n_40_minutes, coalesce(b.n, 0) AS n_one_hour
FROM a FULL JOIN b USING (period_end)""",
    "page_worklist": """
WITH d AS (SELECT DISTINCT strftime(ts, '%Y%m%d') AS day FROM events WHERE ts IS NOT NULL)
SELECT day, CAST(page AS INTEGER) AS page, 'http://news.example.com/' || day || '/index_' || page || '.html' AS url
FROM d, generate_series(1, 5) g(page)""",
    "key_count": f"""
SELECT w AS key, count(*) AS n
FROM (SELECT unnest({_tok('text')}) AS w FROM documents) GROUP BY 1""",
    "key_count_parts": f"""
WITH counts AS (SELECT w AS key, count(*) AS n
                FROM (SELECT unnest({_tok('text')}) AS w FROM documents) GROUP BY 1),
bytes AS (SELECT key, n, list_transform(regexp_extract_all(hex(encode(key)), '(..)', 1),
                                        lambda x: CAST(('0x' || x)::INTEGER AS BIGINT)) AS b FROM counts)
SELECT key, n,
       CAST(list_reduce(list_concat([CAST(0 AS BIGINT)],
                                    list_transform(b, lambda v: CASE WHEN v > 127 THEN v - 256 ELSE v END)),
                        lambda h, v: ((h * 31 + v) % 2147483648 + 2147483648) % 2147483648) % 13 AS INTEGER) AS part
FROM bytes""",
    "numeric_terms": f"""
SELECT term, count(*) AS n_docs
FROM (SELECT DISTINCT doc_id, unnest({_tok('lower(text)')}) AS term FROM documents)
WHERE regexp_matches(term, '{NUMBER_PATTERN}') GROUP BY 1""",
    "half_day_counts": """
SELECT CASE WHEN CAST(ts AS TIME) <= TIME '09:00:00' THEN CAST(ts AS DATE) + INTERVAL 9 HOUR
            WHEN CAST(ts AS TIME) <= TIME '17:30:00' THEN CAST(ts AS DATE) + INTERVAL 17 HOUR + INTERVAL 30 MINUTE
            ELSE CAST(ts AS DATE) + INTERVAL 1 DAY + INTERVAL 9 HOUR END AS period_end,
       CAST(ts AS TIME) <= TIME '09:00:00' OR CAST(ts AS TIME) > TIME '17:30:00' AS am,
       count(*) AS n_events
FROM events GROUP BY 1, 2""",
    "partition_health": """
WITH d AS (SELECT CAST(x AS DATE) AS day
           FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-02-05', INTERVAL 1 DAY)) AS x)),
     o AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_rows, CAST(sum(octet_length(CAST(props AS BLOB))) AS BIGINT) AS n_bytes
           FROM events GROUP BY 1)
SELECT strftime(d.day, '%Y-%m-%d') AS day, CAST(coalesce(o.n_rows, 0) AS BIGINT) AS n_rows, CAST(coalesce(o.n_bytes, 0) AS BIGINT) AS n_bytes,
       CASE WHEN o.n_rows IS NULL THEN 'missing' WHEN coalesce(o.n_bytes, 0) <= 0 THEN 'empty' ELSE 'ok' END AS status
FROM d LEFT JOIN o USING (day)""",
    "hour_worklist": """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS s, date_trunc('hour', max(ts)) AS e FROM events),
     h AS (SELECT unnest(generate_series(s, e, INTERVAL 1 HOUR)) AS hour FROM b),
     c AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n_events FROM events GROUP BY 1)
SELECT strftime(h.hour, '%Y%m%d%H') AS hour_key, coalesce(c.n_events, 0) AS n_events
FROM h LEFT JOIN c USING (hour)""",
}
