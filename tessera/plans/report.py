"""Weekly report queries on the driver tables.

Bindings:
  divisions      region -> province code `RR0000` (RR = regionkey + 11), name r_name;
                 nation -> city code `RRNN00` (NN = nationkey + 1), name n_name;
                 nation -> district `RRNN01` (skipped: not a city code)
  institutions   customers; register address = region name + segment (balance >= 1000),
                 segment + region name (0 <= balance < 1000, never matches: Q17),
                 NULL (balance < 0); office address = 2 letters of the region + segment
                 (NULL for MACHINERY)
  listed         customers, province only for AUTOMOBILE, industry = segment
  industry       class P0207 for every segment but FURNITURE; map below (lower case, F17)
  negatives      per customer: lineitems of its orders, count of l_returnflag = 'R'
  lead news      per customer with negatives: the order with most 'R' lines
  institutions for the part files: suppliers, category from nation / balance
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import report as R
from tessera.plans.common import r6, tables
from tessera.sources.snapshot import BucketedTable
from tessera.sources.store import derived_folder, derived_table

REPORT_DATE = "2024-01-29"
WEEK_BEFORE = "2024-01-22"
EXCLUDED = R.EXCLUDED_AREA_NAMES + ["NATION_0"]
INDUSTRY_MAP = [("automobile", "s1"), ("building", "s1"), ("household", "s2"), ("machinery", "s3")]
INDUSTRY_NAMES = [("s1", "Industrials"), ("s2", "Consumer"), ("s3", "Machines"), ("s4", "Unused")]


def _divisions(t):
    r = t.region.select(F.format_string("%02d0000", F.col("r_regionkey") + 11).alias("code"),
                        F.col("r_name").alias("name"))
    n = t.nation.select(F.format_string("%02d%02d00", F.col("n_regionkey") + 11, F.col("n_nationkey") + 1)
                        .alias("code"), F.col("n_name").alias("name"))
    d = t.nation.select(F.format_string("%02d%02d01", F.col("n_regionkey") + 11, F.col("n_nationkey") + 1)
                        .alias("code"), F.concat(F.col("n_name"), F.lit("X")).alias("name"))
    return r.unionByName(n).unionByName(d)


def _customers(t):
    c = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == F.col("r_regionkey"))


def _institutions(t):
    c = _customers(t)
    reg = (F.when(F.col("c_acctbal") >= 1000, F.concat_ws(" ", "r_name", "c_mktsegment"))
            .when(F.col("c_acctbal") >= 0, F.concat_ws(" ", "c_mktsegment", "r_name")))
    off = F.when(F.col("c_mktsegment") != "MACHINERY",
                 F.concat(F.substring("r_name", 1, 2), F.col("c_mktsegment")))
    return c.select(F.col("c_custkey").alias("institutionid"), F.col("c_name").alias("shortname"),
                    F.concat_ws(" ", "c_name", "c_mktsegment").alias("fullname"),
                    reg.alias("registeraddress"), off.alias("officeaddress"))


def _listed(t):
    c = _customers(t)
    return c.select(F.col("c_custkey").alias("institutionid"),
                    F.when(F.col("c_mktsegment") == "AUTOMOBILE",
                           F.format_string("%02d0000", F.col("r_regionkey") + 11)).alias("province_code"),
                    F.col("c_name").alias("shortname"), F.col("c_mktsegment").alias("industry_code"))


def _inputs(t, *names):
    return [f"{t._dir.rstrip('/')}/{n}.parquet" for n in names]


def _negatives(t):
    """Negative-news counts per institution: in the reference an upstream
    file (S7); here written once per input to the shared folder, so the five
    update sources of the weekly table read it instead of re-joining
    lineitem x orders each."""
    def build():
        li = t.lineitem.select("l_orderkey", "l_returnflag")
        o = t.orders.select("o_orderkey", "o_custkey")
        per = (li.join(o, li.l_orderkey == o.o_orderkey)
                 .groupBy(F.col("o_custkey").alias("institutionid"))
                 .agg(F.count(F.lit(1)).alias("news_count"),
                      F.count_if(F.col("l_returnflag") == "R").alias("news_count_neg")))
        c = t.customer.select(F.col("c_custkey").alias("institutionid"), F.col("c_name").alias("shortname"),
                              F.concat_ws(" ", "c_name", "c_mktsegment").alias("fullname"))
        return per.join(c, "institutionid")
    return derived_table(t._spark, "weekly_negatives", _inputs(t, "lineitem", "orders", "customer"), build)


def _lead_news(t):
    """Lead negative news per institution (the reference's key=value file,
    S9), written once per input like the counts."""
    def build():
        li = t.lineitem.where(F.col("l_returnflag") == "R").select("l_orderkey")
        o = t.orders.select("o_orderkey", "o_custkey")
        per = (li.join(o, li.l_orderkey == o.o_orderkey)
                 .groupBy("o_custkey", "o_orderkey").agg(F.count(F.lit(1)).alias("n")))
        return per.groupBy(F.col("o_custkey").alias("institutionid")).agg(
            F.max_by("o_orderkey", F.struct("n", -F.col("o_orderkey"))).alias("neg_news_id"))
    return derived_table(t._spark, "weekly_lead_news", _inputs(t, "lineitem", "orders"), build)


def _assigned(t):
    prefixes = R.province_prefixes(_divisions(t), EXCLUDED)
    neg = _negatives(t)
    return R.assign_provinces(neg, _institutions(t), _listed(t), prefixes), neg, prefixes


def province_rollup(spark, sf_dir):
    t = tables(spark, sf_dir)
    a, neg, p = _assigned(t)
    return R.province_rollup(a, neg, p).select("province_code", "location_name", "total_neg",
                                               "n_institutions", r6("log_neg").alias("log_neg"))


def province_status(spark, sf_dir):
    t = tables(spark, sf_dir)
    a, _, _ = _assigned(t)
    return R.match_counters(a)


def province_members(spark, sf_dir):
    t = tables(spark, sf_dir)
    a, neg, _ = _assigned(t)
    return R.province_members(a, neg)


def _industry(spark, t):
    ic = t.customer.select(F.col("c_mktsegment").alias("industry_code")).distinct().select(
        "industry_code", F.when(F.col("industry_code") == "FURNITURE", "P0000").otherwise("P0207")
        .alias("classification_id"))
    iset = t.customer.select(F.col("c_mktsegment").alias("industry_code")).distinct().select(
        "industry_code", F.initcap("industry_code").alias("industry_name"),
        F.lit("P0207").alias("system_code"), F.lit(2).alias("rank"))
    m = spark.createDataFrame(INDUSTRY_MAP, "base_code string, new_code string")
    return R.institution_industries(_listed(t), ic, iset, m)


def _names(spark):
    return spark.createDataFrame(INDUSTRY_NAMES, "code string, name string")


def industry_rollup(spark, sf_dir):
    t = tables(spark, sf_dir)
    out = R.industry_rollup(_industry(spark, t), _negatives(t), _names(spark))
    return out.select("industry", "industry_name", "total_neg", "n_institutions", r6("log_neg").alias("log_neg"))


def _weekly_sources(spark, t):
    a, neg, p = _assigned(t)
    return [R.geo_updates(a, neg, p), R.industry_updates(_industry(spark, t), neg, _names(spark)),
            R.media_updates(neg), R.lead_news_updates(_lead_news(t))]


def _weekly_shown(out):
    return out.select("institutionid", F.date_format("report_date", "yyyy-MM-dd").alias("report_date"),
                      "location", "location_name", "industry", "industry_name",
                      # NULL when no source touched it: a nullable integer leaves as
                      # double so every client reads one numeric kind
                      F.col("news_count").cast("double").alias("news_count"),
                      F.col("news_count_neg").cast("double").alias("news_count_neg"),
                      F.coalesce("neg_top_flag", F.lit(0)).alias("neg_top_flag"),
                      F.col("neg_news_id").cast("string").alias("neg_news_id"), "shortname", "fullname")


def weekly_upsert(spark, sf_dir):
    t = tables(spark, sf_dir)
    ups = _weekly_sources(spark, t)
    existing = ups[0].withColumn("report_date", F.to_date(F.lit(REPORT_DATE)))
    out = R.weekly_upsert(existing, ups, REPORT_DATE)
    return _weekly_shown(out).withColumn("news_count", F.col("news_count").cast("bigint"))


def _weekly_before(t):
    """A weekly table of its own: customers at the report date (every third,
    old values), at the week before (every second)."""
    c = t.customer.select(F.col("c_custkey").alias("institutionid"), "c_name", "c_mktsegment", "c_acctbal")
    def rows(every, date, flag):
        return c.where(F.col("institutionid") % every == 0).select(
            "institutionid", F.to_date(F.lit(date)).alias("report_date"), F.lit(None).cast("string").alias("location"),
            F.lit("before").alias("location_name"), F.lower("c_mktsegment").alias("industry"), F.lit(None).cast("string").alias("industry_name"),
            F.lit(7).cast("bigint").alias("news_count"), F.when(F.col("c_acctbal") > 0, 3).cast("bigint").alias("news_count_neg"),
            F.lit(flag).alias("neg_top_flag"), F.lit(None).cast("bigint").alias("neg_news_id"), F.col("c_name").alias("shortname"), F.lit(None).cast("string").alias("fullname"))
    return rows(3, REPORT_DATE, 0).unionByName(rows(2, WEEK_BEFORE, 1))


def _weekly_table(spark, t):
    """The stored weekly table after the sources of the report date were merged
    into it, delivered twice."""
    keys, wanted = ["institutionid"], _inputs(t, "customer", "nation", "region", "lineitem", "orders")

    def build(path):
        table = BucketedTable(spark, path, keys, partition="report_date")
        table.create(_weekly_before(t))
        update = R.combined_updates(_weekly_sources(spark, t), REPORT_DATE)
        for _ in range(2):
            table.merge(update, R.weekly_merge, REPORT_DATE)
    return BucketedTable(spark, derived_folder(spark, "weekly-table", wanted, build), keys, partition="report_date")


def weekly_existing(spark, sf_dir):
    """J19 into a table with rows of its own, of this and another date."""
    return _weekly_shown(_weekly_table(spark, tables(spark, sf_dir)).read())


def weekly_conflicts(spark, sf_dir):
    """What the sources of the report date change in that table."""
    t = tables(spark, sf_dir)
    return R.conflict_counts(_weekly_before(t), R.combined_updates(_weekly_sources(spark, t), REPORT_DATE))


def institution_parts(spark, sf_dir):
    t = tables(spark, sf_dir)
    s = t.supplier.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    n = t.nation.select("n_nationkey", "n_name")
    inst = s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("s_suppkey").alias("institutionid"), F.col("s_name").alias("shortname"),
        F.concat(F.col("s_name"), F.lit("("), F.col("n_name"), F.lit("）")).alias("fullname"),
        F.when(F.col("s_acctbal") < 0, F.lit("P0499"))
         .otherwise(F.format_string("P04%02d", F.col("s_nationkey") + 10)).alias("categoryid"))
    return R.institution_parts(inst)


QUERIES = {
    "province_rollup": province_rollup,
    "province_status": province_status,
    "province_members": province_members,
    "industry_rollup": industry_rollup,
    "weekly_upsert": weekly_upsert,
    "weekly_existing": weekly_existing,
    "weekly_conflicts": weekly_conflicts,
    "institution_parts": institution_parts,
}


# ---------------------------------------------------------------- oracle SQL

_EXCL = ", ".join(f"'{w}'" for w in EXCLUDED)

GEO_SQL = f"""
divisions AS (
  SELECT printf('%02d0000', r_regionkey + 11) AS code, r_name AS name FROM region
  UNION ALL SELECT printf('%02d%02d00', n_regionkey + 11, n_nationkey + 1), n_name FROM nation
  UNION ALL SELECT printf('%02d%02d01', n_regionkey + 11, n_nationkey + 1), n_name || 'X' FROM nation),
prefixes AS (
  SELECT code AS province_code, 0 AS pos,
         CASE WHEN starts_with(name, '内蒙') OR starts_with(name, '黑龙') THEN substr(name, 1, 3)
              ELSE substr(name, 1, 2) END AS prefix
  FROM divisions WHERE substr(code, 3, 4) = '0000'
  UNION ALL
  SELECT substr(code, 1, 2) || '0000', row_number() OVER (PARTITION BY substr(code, 1, 2) ORDER BY code),
         substr(name, 1, 2)
  FROM divisions WHERE substr(code, 5, 2) = '00' AND substr(code, 3, 4) <> '0000'
    AND name NOT IN ({_EXCL}) AND substr(name, 1, 2) <> ''),
pnames AS (SELECT province_code, arg_min(prefix, pos) AS location_name FROM prefixes GROUP BY 1),
cust AS (SELECT c.*, r.r_regionkey, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
         JOIN region r ON n.n_regionkey = r.r_regionkey),
inst AS (SELECT c_custkey AS institutionid,
                CASE WHEN c_acctbal >= 1000 THEN r_name || ' ' || c_mktsegment
                     WHEN c_acctbal >= 0 THEN c_mktsegment || ' ' || r_name END AS reg,
                CASE WHEN c_mktsegment <> 'MACHINERY' THEN substr(r_name, 1, 2) || c_mktsegment END AS off
         FROM cust),
listed AS (SELECT c_custkey AS institutionid, printf('%02d0000', r_regionkey + 11) AS listed_code
           FROM cust WHERE c_mktsegment = 'AUTOMOBILE'),
neg AS (SELECT o.o_custkey AS institutionid, count(*) AS news_count,
               count(*) FILTER (WHERE l.l_returnflag = 'R') AS news_count_neg
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1),
negs AS (SELECT neg.*, c.c_name AS shortname, c.c_name || ' ' || c.c_mktsegment AS fullname
         FROM neg JOIN customer c ON c.c_custkey = neg.institutionid),
subs AS (SELECT * FROM (VALUES {", ".join(f"({s}, {n})" for s, n in R._SUBSTRINGS)}) t(s, n)),
addr AS (SELECT institutionid, 'reg' AS kind, reg AS a FROM inst WHERE reg IS NOT NULL AND reg <> ''
         UNION ALL SELECT institutionid, 'off', off FROM inst WHERE off IS NOT NULL AND off <> ''),
cand AS (SELECT institutionid, kind, substr(substr(a, 1, 6), s, n) AS prefix, n FROM addr, subs),
best AS (SELECT institutionid, kind, arg_min(p.province_code, (p.province_code, p.pos)) AS code
         FROM cand JOIN prefixes p USING (prefix) WHERE length(cand.prefix) = cand.n GROUP BY 1, 2),
assigned AS (
  SELECT negs.institutionid,
         CASE WHEN l.listed_code IS NOT NULL THEN l.listed_code
              WHEN i.institutionid IS NULL THEN NULL
              WHEN coalesce(i.reg, '') <> '' AND br.code IS NOT NULL THEN br.code
              WHEN coalesce(i.reg, '') = '' AND coalesce(i.off, '') <> '' THEN bo.code END AS province_code,
         CASE WHEN l.listed_code IS NOT NULL THEN 'listed'
              WHEN i.institutionid IS NULL THEN 'error'
              WHEN coalesce(i.reg, '') = '' AND coalesce(i.off, '') = '' THEN 'no_address'
              WHEN (coalesce(i.reg, '') <> '' AND br.code IS NOT NULL)
                OR (coalesce(i.reg, '') = '' AND bo.code IS NOT NULL) THEN 'matched'
              ELSE 'unmatched' END AS status
  FROM negs LEFT JOIN listed l USING (institutionid) LEFT JOIN inst i USING (institutionid)
  LEFT JOIN best br ON br.institutionid = negs.institutionid AND br.kind = 'reg'
  LEFT JOIN best bo ON bo.institutionid = negs.institutionid AND bo.kind = 'off')"""

PROVINCE_ROLLUP_SQL = "WITH " + GEO_SQL + """
SELECT a.province_code, pn.location_name, CAST(sum(n.news_count_neg) AS BIGINT) AS total_neg,
       count(*) AS n_institutions, round(ln(1 + sum(n.news_count_neg)), 6) + 0.0 AS log_neg
FROM assigned a JOIN negs n USING (institutionid) LEFT JOIN pnames pn USING (province_code)
WHERE a.province_code IS NOT NULL GROUP BY 1, 2"""

PROVINCE_STATUS_SQL = "WITH " + GEO_SQL + """
SELECT status, count(*) AS n FROM assigned GROUP BY 1
UNION ALL SELECT 'total', count(*) FROM assigned"""

PROVINCE_MEMBERS_SQL = "WITH " + GEO_SQL + """
SELECT a.province_code, a.institutionid, n.shortname, n.news_count_neg,
       printf('%d:%s:%d', a.institutionid, coalesce(n.shortname, ''), n.news_count_neg) AS entry
FROM assigned a JOIN negs n USING (institutionid) WHERE a.province_code IS NOT NULL"""

IND_SQL = f"""
seg AS (SELECT DISTINCT c_mktsegment AS industry_code FROM customer),
ic AS (SELECT industry_code, CASE WHEN industry_code = 'FURNITURE' THEN 'P0000' ELSE 'P0207' END AS classification_id
       FROM seg),
iset AS (SELECT industry_code, upper(substr(industry_code, 1, 1)) || lower(substr(industry_code, 2)) AS industry_name, 'P0207' AS system_code FROM seg),
lst AS (SELECT c_custkey AS institutionid, c_name AS shortname, c_mktsegment AS industry_code FROM customer),
j13 AS (SELECT DISTINCT lst.institutionid, lst.shortname, s.industry_code, s.industry_name
        FROM lst LEFT JOIN ic ON lst.industry_code = ic.industry_code AND ic.classification_id = 'P0207'
        JOIN iset s ON ic.industry_code = s.industry_code AND ic.classification_id = s.system_code),
imap AS (SELECT upper(b) AS base, upper(n) AS industry FROM (VALUES {", ".join(f"('{b}', '{n}')" for b, n in INDUSTRY_MAP)}) t(b, n)),
inames AS (SELECT upper(c) AS industry, nm AS industry_name FROM (VALUES {", ".join(f"('{c}', '{n}')" for c, n in INDUSTRY_NAMES)}) t(c, nm)),
ind AS (SELECT institutionid, min(industry) AS industry FROM j13 JOIN imap ON upper(j13.industry_code) = imap.base
        GROUP BY 1)"""

INDUSTRY_ROLLUP_SQL = "WITH " + GEO_SQL + "," + IND_SQL + """
SELECT ind.industry, inames.industry_name, CAST(coalesce(sum(negs.news_count_neg), 0) AS BIGINT) AS total_neg,
       count(negs.news_count_neg) AS n_institutions,
       round(ln(1 + coalesce(sum(negs.news_count_neg), 0)), 6) + 0.0 AS log_neg
FROM ind LEFT JOIN negs USING (institutionid) LEFT JOIN inames USING (industry) GROUP BY 1, 2"""

WEEKLY_SQL = "WITH " + GEO_SQL + "," + IND_SQL + """,
geo AS (SELECT a.institutionid, a.province_code AS location, pn.location_name, n.news_count_neg,
               nullif(n.shortname, '') AS shortname, nullif(n.fullname, '') AS fullname
        FROM assigned a JOIN negs n USING (institutionid) LEFT JOIN pnames pn USING (province_code)
        WHERE a.province_code IS NOT NULL),
indu AS (SELECT ind.institutionid, ind.industry, inames.industry_name, n.news_count_neg,
                nullif(n.shortname, '') AS shortname, nullif(n.fullname, '') AS fullname
         FROM ind JOIN negs n USING (institutionid) LEFT JOIN inames USING (industry)),
lead AS (SELECT o_custkey AS institutionid, arg_max(o_orderkey, (n, -o_orderkey)) AS neg_news_id
         FROM (SELECT o.o_custkey, o.o_orderkey, count(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
               WHERE l.l_returnflag = 'R' GROUP BY 1, 2) GROUP BY 1),
ids AS (SELECT institutionid FROM geo UNION SELECT institutionid FROM indu UNION SELECT institutionid FROM negs
        UNION SELECT institutionid FROM lead)
SELECT ids.institutionid, '""" + REPORT_DATE + """' AS report_date,
       geo.location, geo.location_name, indu.industry, indu.industry_name, negs.news_count,
       CAST(coalesce(indu.news_count_neg, geo.news_count_neg) AS DOUBLE) AS news_count_neg,
       CASE WHEN lead.institutionid IS NOT NULL THEN 1 ELSE 0 END AS neg_top_flag,
       CAST(lead.neg_news_id AS VARCHAR) AS neg_news_id,
       coalesce(nullif(negs.shortname, ''), indu.shortname, geo.shortname) AS shortname,
       coalesce(nullif(negs.fullname, ''), indu.fullname, geo.fullname) AS fullname
FROM ids LEFT JOIN geo USING (institutionid) LEFT JOIN indu USING (institutionid)
LEFT JOIN negs USING (institutionid) LEFT JOIN lead USING (institutionid)"""

BEFORE_SQL = " UNION ALL ".join(f"""
SELECT c_custkey AS institutionid, '{date}' AS report_date, CAST(NULL AS VARCHAR) AS location, 'before' AS location_name, lower(c_mktsegment) AS industry,
       CAST(NULL AS VARCHAR) AS industry_name, 7.0::DOUBLE AS news_count, CASE WHEN c_acctbal > 0 THEN 3.0::DOUBLE END AS news_count_neg, {flag} AS neg_top_flag,
       CAST(NULL AS VARCHAR) AS neg_news_id, c_name AS shortname, CAST(NULL AS VARCHAR) AS fullname FROM customer WHERE c_custkey % {every} = 0"""
                        for every, date, flag in ((3, REPORT_DATE, 0), (2, WEEK_BEFORE, 1)))
# a NULL flag does not overwrite, so the sources' flag is NULL without lead news
UPDATE_SQL = WEEKLY_SQL.replace("ELSE 0 END AS neg_top_flag", "END AS neg_top_flag")
_WEEKLY = ["location", "location_name", "industry", "industry_name", "news_count", "news_count_neg", "neg_top_flag", "neg_news_id", "shortname", "fullname"]
WEEKLY_EXISTING_SQL = f"""
SELECT institutionid, report_date, {", ".join(f"coalesce(u.{c}, b.{c}{', 0' if c == 'neg_top_flag' else ''}) AS {c}" for c in _WEEKLY)}
FROM ({BEFORE_SQL}) b FULL JOIN ({UPDATE_SQL}) u USING (institutionid, report_date)"""


def _number(c, t):
    return f"CAST({t}.{c} AS BIGINT)" if c in ("news_count", "news_count_neg", "neg_top_flag") else f"{t}.{c}"


WEEKLY_CONFLICTS_SQL = f"""WITH j AS (SELECT {", ".join(f"CAST({_number(c, 'b')} AS VARCHAR) AS o_{c}, CAST({_number(c, 'u')} AS VARCHAR) AS n_{c}" for c in _WEEKLY)}
           FROM ({BEFORE_SQL}) b JOIN ({UPDATE_SQL}) u USING (institutionid, report_date))
""" + " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(*) AS existing, count(*) FILTER (WHERE o_{c} <> n_{c}) AS replaced,
       count(*) FILTER (WHERE o_{c} IS NULL AND n_{c} IS NOT NULL) AS filled, count(*) FILTER (WHERE o_{c} = n_{c}) AS same FROM j""" for c in _WEEKLY)

INSTITUTION_PARTS_SQL = """
WITH inst AS (SELECT s.s_suppkey AS institutionid, s.s_name AS shortname, s.s_name || '(' || n.n_name || '）' AS fullname,
                     CASE WHEN s.s_acctbal < 0 THEN 'P0499' ELSE printf('P04%02d', s.s_nationkey + 10) END AS categoryid
              FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
sel AS (SELECT * FROM inst WHERE regexp_matches(categoryid, '^P041[4-5]$') OR categoryid = 'P0499'),
tot AS (SELECT count(DISTINCT institutionid) AS total FROM sel),
idx AS (SELECT *, row_number() OVER (ORDER BY institutionid) - 1 AS ix FROM sel)
SELECT institutionid, replace(replace(replace(replace(coalesce(shortname, ''), '(', ''), ')', ''), '（', ''), '）', '') AS shortname,
       replace(replace(replace(replace(coalesce(fullname, ''), '(', ''), ')', ''), '（', ''), '）', '') AS fullname,
       CAST(floor(ix / greatest(1, floor(total / 1000.0))) AS BIGINT) AS part
FROM idx, tot"""

ORACLE = {
    "province_rollup": PROVINCE_ROLLUP_SQL,
    "province_status": PROVINCE_STATUS_SQL,
    "province_members": PROVINCE_MEMBERS_SQL,
    "industry_rollup": INDUSTRY_ROLLUP_SQL,
    "weekly_upsert": WEEKLY_SQL,
    "weekly_existing": WEEKLY_EXISTING_SQL,
    "weekly_conflicts": WEEKLY_CONFLICTS_SQL,
    "institution_parts": INSTITUTION_PARTS_SQL,
}
