"""Fund queries bound to the driver tables.

fund_indicators        fund = customer nation, category = region,
                       date = o_orderdate, per_nav = avg(o_totalprice) per day,
                       as-of 2001-08-01, price path (W1).
fund_income_indicators fund = supplier nation, date = l_shipdate,
                       wan_per_nav = avg(l_tax) * 10, per_nav = 1 + avg(l_discount),
                       as-of 2001-11-04, income path (W3 + A8).
fund_compare_wide      fund_indicators pivoted, company name via nation -> region.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import funds as ops
from tessera.plans.common import r6, rf, sql_r6, sql_rf, tables

LOOKBACKS = [("day", 7), ("day", 30), ("month", 0), ("month", 3), ("month", 6),
             ("month", 12), ("year", 0), ("year", 1), ("year", 3), ("all", None)]
CATEGORIES = ["0", "1", "2", "3", "4"]
PRICE_AS_OF = "2001-07-10"
INCOME_AS_OF = "2001-11-04"
BOUNDED = ["annual_volatility", "sharp_ratio", "max_drawdown"]
UNBOUNDED = ["annual_return", "calmar_ratio"]


def _fund_category(t):
    return t.nation.select(F.col("n_nationkey").cast("string").alias("code"),
                           F.col("n_regionkey").cast("string").alias("category"))


def price_nav(t):
    """Daily NAV per customer nation: one partial+final aggregate."""
    o = t.orders.select("o_custkey", "o_orderdate", "o_totalprice")
    c = t.customer.select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .groupBy(F.col("c_nationkey").cast("string").alias("code"),
                      F.to_date("o_orderdate").alias("date"))
             .agg(F.avg("o_totalprice").alias("per_nav"))
             .withColumn("wan_per_nav", F.lit(None).cast("double")))


def income_nav(t):
    li = t.lineitem.select("l_suppkey", "l_shipdate", "l_tax", "l_discount")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    return (li.join(s, li.l_suppkey == s.s_suppkey)
              .groupBy(F.col("s_nationkey").cast("string").alias("code"),
                       F.to_date("l_shipdate").alias("date"))
              .agg((F.avg("l_tax") * 10).alias("wan_per_nav"),
                   (1 + F.avg("l_discount")).alias("per_nav")))


def _finish(df):
    return df.select("category", "code", "interval", "lag", "lookback", "n_days",
                     *[rf(c).alias(c) for c in UNBOUNDED], *[r6(c).alias(c) for c in BOUNDED])


def fund_indicators(spark, sf_dir):
    t = tables(spark, sf_dir)
    out = ops.fund_indicators(price_nav(t), _fund_category(t), categories=CATEGORIES,
                              methods={c: ops.PER_NAV for c in CATEGORIES},
                              lookbacks=LOOKBACKS, as_of=PRICE_AS_OF)
    return _finish(out)


def fund_income_indicators(spark, sf_dir):
    t = tables(spark, sf_dir)
    out = ops.fund_indicators(income_nav(t), _fund_category(t), categories=CATEGORIES,
                              methods={c: ops.WAN_PER_NAV for c in CATEGORIES},
                              lookbacks=LOOKBACKS, as_of=INCOME_AS_OF)
    return _finish(out)


def fund_compare_wide(spark, sf_dir):
    t = tables(spark, sf_dir)
    long = ops.fund_indicators(price_nav(t), _fund_category(t), categories=CATEGORIES,
                               methods={c: ops.PER_NAV for c in CATEGORIES},
                               lookbacks=LOOKBACKS, as_of=PRICE_AS_OF)
    long = long.select("category", "code", "lookback", *[rf(c).alias(c) for c in UNBOUNDED],
                       *[r6(c).alias(c) for c in BOUNDED])
    sec = t.nation.select(F.col("n_nationkey").cast("string").alias("code"),
                          F.col("n_regionkey").alias("company_code"),
                          F.format_string("059%02d", F.col("n_regionkey")).alias("security_type"))
    comp = t.region.select(F.col("r_regionkey").alias("company_code"),
                           F.col("r_name").alias("company_name"))
    return ops.compare_wide(long, ops.company_names(sec, comp), LOOKBACKS)


# ---------------------------------------------------------------- oracle SQL

def _windows_sql(as_of: str) -> str:
    d = f"DATE '{as_of}'"
    rows = []
    for i, (u, c) in enumerate(LOOKBACKS):
        label = ops.lookback_label(u, c)
        if c is None:
            frm = "CAST(NULL AS DATE)"
        elif u == "day":
            frm = f"CAST({d} - INTERVAL {c} DAY AS DATE)"
        elif c == 0:
            frm = f"CAST(date_trunc('{u}', {d}) AS DATE)"
        elif u == "month":
            frm = f"CAST({d} - INTERVAL {c} MONTH AS DATE)"
        else:
            frm = f"CAST({d} - INTERVAL {12 * c} MONTH AS DATE)"
        lag = "all" if c is None else str(c)
        rows.append(f"({i}, '{u}', '{lag}', '{label}', {frm})")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(w_id, interval, lag, lookback, from_date)"


def _indicator_sql(nav_sql: str, as_of: str, income: bool) -> str:
    d = f"DATE '{as_of}'"
    cats = ", ".join(f"'{c}'" for c in CATEGORIES)
    if income:
        series = """
  s0 AS (SELECT fl.category, fl.code, w.w_id, nav.date,
                nav.wan_per_nav / 10000.0 / nav.per_nav AS ret
         FROM nav JOIN fl USING (code) JOIN wins w
           ON nav.date <= {d} AND (w.from_date IS NULL OR nav.date >= w.from_date)
         WHERE nav.per_nav IS NOT NULL AND nav.wan_per_nav IS NOT NULL),
  s1 AS (SELECT *, row_number() OVER (PARTITION BY category, code, w_id ORDER BY date) AS rn,
                product(1 + ret) OVER (PARTITION BY category, code, w_id
                    ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
         FROM s0),"""
    else:
        series = """
  s0 AS (SELECT fl.category, fl.code, w.w_id, nav.date, nav.per_nav AS price
         FROM nav JOIN fl USING (code) JOIN wins w
           ON nav.date <= {d} AND (w.from_date IS NULL OR nav.date >= w.from_date)
         WHERE nav.per_nav IS NOT NULL),
  s1 AS (SELECT *, row_number() OVER (PARTITION BY category, code, w_id ORDER BY date) AS rn,
                coalesce(price / lag(price) OVER (PARTITION BY category, code, w_id ORDER BY date) - 1, 0.0) AS ret
         FROM s0),"""
    series = series.format(d=d)
    return f"""
WITH nav AS ({nav_sql}),
  fc AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, CAST(n_regionkey AS VARCHAR) AS category FROM nation),
  fl AS (SELECT DISTINCT code, category FROM fc
         WHERE category IN ({cats}) AND code IN (SELECT code FROM nav WHERE date = {d})),
  wins AS ({_windows_sql(as_of)}),{series}
  s2 AS (SELECT *, CASE WHEN rn > 1 THEN (pk - price) / pk ELSE 0.0 END AS dd
         FROM (SELECT *, max(CASE WHEN rn > 1 THEN price END) OVER (PARTITION BY category, code, w_id
                    ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pk FROM s1) x),
  st AS (SELECT category, code, w_id, count(*) AS n, arg_min(price, date) AS p_first,
                arg_max(price, date) AS p_last, avg(ret) AS r_mean, stddev_pop(ret) AS r_std, max(dd) AS mdd
         FROM s2 GROUP BY 1, 2, 3),
  ind AS (SELECT category, code, w_id, n,
                 pow(p_last / p_first, 252.0 / (n + 1)) - 1 AS annual_return,
                 r_std * sqrt(252.0) AS annual_volatility,
                 CASE WHEN r_std <> 0 THEN r_mean / r_std * sqrt(252.0) END AS sharp_ratio,
                 mdd AS max_drawdown,
                 CASE WHEN abs(mdd) > 1e-6 THEN (pow(p_last / p_first, 252.0 / (n + 1)) - 1 - 0.03) / mdd END
                   AS calmar_ratio
          FROM st)
SELECT fl.category, fl.code, w.interval, w.lag, w.lookback, CAST(coalesce(ind.n, 0) AS BIGINT) AS n_days,
       {sql_rf('ind.annual_return')} AS annual_return, {sql_rf('ind.calmar_ratio')} AS calmar_ratio,
       {sql_r6('ind.annual_volatility')} AS annual_volatility, {sql_r6('ind.sharp_ratio')} AS sharp_ratio,
       {sql_r6('ind.max_drawdown')} AS max_drawdown
FROM fl CROSS JOIN wins w
LEFT JOIN ind ON ind.category = fl.category AND ind.code = fl.code AND ind.w_id = w.w_id
"""


PRICE_NAV_SQL = """SELECT CAST(c.c_nationkey AS VARCHAR) AS code, CAST(o.o_orderdate AS DATE) AS date,
       avg(o.o_totalprice) AS per_nav, CAST(NULL AS DOUBLE) AS wan_per_nav
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2"""

INCOME_NAV_SQL = """SELECT CAST(s.s_nationkey AS VARCHAR) AS code, CAST(l.l_shipdate AS DATE) AS date,
       avg(l.l_tax) * 10 AS wan_per_nav, 1 + avg(l.l_discount) AS per_nav
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2"""


def _wide_sql() -> str:
    long = _indicator_sql(PRICE_NAV_SQL, PRICE_AS_OF, income=False)
    inds = UNBOUNDED + BOUNDED
    order = ["annual_return", "annual_volatility", "sharp_ratio", "max_drawdown", "calmar_ratio"]
    cols = []
    for i in order:
        for u, c in LOOKBACKS:
            lab = ops.lookback_label(u, c)
            cols.append(f"max(CASE WHEN lookback = '{lab}' THEN {i} END) AS {i}_{lab}")
    assert set(inds) == set(order)
    return f"""
WITH lng AS ({long}),
  names AS (SELECT CAST(n.n_nationkey AS VARCHAR) AS code, min(r.r_name) AS company
            FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
            WHERE printf('059%02d', n.n_regionkey) LIKE '059%' GROUP BY 1),
  wide AS (SELECT category, code, {', '.join(cols)} FROM lng GROUP BY category, code)
SELECT wide.category, wide.code, coalesce(names.company, wide.code) AS company,
       {', '.join(f'wide.{i}_{ops.lookback_label(u, c)}' for i in order for u, c in LOOKBACKS)}
FROM wide LEFT JOIN names USING (code)
"""


QUERIES = {
    "fund_indicators": fund_indicators,
    "fund_income_indicators": fund_income_indicators,
    "fund_compare_wide": fund_compare_wide,
}

ORACLE = {
    "fund_indicators": _indicator_sql(PRICE_NAV_SQL, PRICE_AS_OF, income=False),
    "fund_income_indicators": _indicator_sql(INCOME_NAV_SQL, INCOME_AS_OF, income=True),
    "fund_compare_wide": _wide_sql(),
}
