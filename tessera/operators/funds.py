"""Fund indicators over many look-back windows (J1 J2 J3 P1 P6 P21 P22 W1 W2 W3
A8-A13 A23 A24 U1 T8).

Plan shape (one job for every fund, window and indicator):

  nav (code, date, per_nav, wan_per_nav)          -- one row per fund and day
    INNER JOIN fund list (code, category, method)  -- J1 / P22, small side
    WHERE date <= as_of AND values not NULL        -- P1, pushed to the scan
    x explode(windows) WHERE date >= from_date     -- J3, windows are config (bounded)
    WINDOW PARTITION BY (category, code, w_id) ORDER BY date
           lag -> returns (W1) or running sum(ln(1+r)) -> prices (A8)
           running max excluding first row -> drawdown (W2)
    GROUP BY (category, code, w_id)                -- A9..A13 inputs
    RIGHT JOIN fund list x windows (explode)       -- A24: blanks when no series

Window partitions hold one row per day of one fund, so their size is bounded by
the calendar (a few thousand rows), never by the data volume: the daily NAV is
aggregated before any window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.dates import lag_date, validate_lookbacks
from tessera.functions.indicators import ALL_INDICATORS, indicator_columns

PER_NAV = "per_nav"
WAN_PER_NAV = "wan_per_nav"


def lookback_label(unit: str, count) -> str:
    return f"{unit}_{'all' if count is None else count}"


def windows_array(lookbacks, as_of: str):
    """J3 build side: the configured look-backs as an array of structs
    (w_id, interval, lag, lookback, from_date, to_date).  It is configuration
    (a handful of entries), expanded per row with `explode`, so no join."""
    lbs = validate_lookbacks(lookbacks)
    as_of_c = F.to_date(F.lit(as_of))
    items = []
    for i, (u, c) in enumerate(lbs):
        frm = lag_date(as_of_c, F.lit(u), F.lit(c).cast("int"))
        items.append(F.struct(F.lit(i).alias("w_id"), F.lit(u).alias("interval"),
                              F.lit("all" if c is None else str(c)).alias("lag"),
                              F.lit(lookback_label(u, c)).alias("lookback"),
                              frm.alias("from_date"), as_of_c.alias("to_date")))
    return F.array(*items)


def method_column(category, methods: dict) -> F.Column:
    """Category -> series method; config only, so a CASE, not a join."""
    expr = None
    for cat, m in methods.items():
        if m not in (PER_NAV, WAN_PER_NAV):
            raise ValueError(f"unknown method {m!r} for category {cat!r}")
        cond = category == F.lit(cat)
        expr = F.when(cond, F.lit(m)) if expr is None else expr.when(cond, F.lit(m))
    return expr


def fund_list(nav: DataFrame, fund_category: DataFrame, categories, methods: dict,
              as_of: str, funds=None) -> DataFrame:
    """Funds of the categories that are priced on `as_of`; P22: an
    explicit fund list replaces that selection.  Unmapped categories raise
    before any job runs (P21)."""
    missing = [c for c in categories if c not in methods]
    if missing:
        raise ValueError(f"not defined proper function for category {missing}")
    spark = nav.sparkSession
    if funds:
        codes = spark.createDataFrame([(f,) for f in funds], "code string")
        # every listed fund in every category (both are job arguments)
        fl = codes.select("code", F.explode(F.array(*[F.lit(c) for c in categories])).alias("category"))
    else:
        priced = nav.where(F.col("date") == F.to_date(F.lit(as_of))).select("code")
        fl = (fund_category.where(F.col("category").isin(list(categories)))
              .select("code", "category")
              .join(priced, "code", "left_semi")
              .distinct())
    return fl.withColumn("method", method_column(F.col("category"), methods))


def series(nav: DataFrame, funds: DataFrame, windows: DataFrame) -> DataFrame:
    """Per (fund, window) ordered series with `price` and `ret` columns."""
    s = (nav.join(funds, "code")
         .where(F.col("per_nav").isNotNull()
                & (F.col("wan_per_nav").isNotNull() | (F.col("method") == PER_NAV))))
    s = (s.select("*", F.explode(windows).alias("_w")).select("*", "_w.w_id", "_w.from_date", "_w.to_date")
          .drop("_w")
          .where((F.col("date") <= F.col("to_date"))
                 & (F.col("from_date").isNull() | (F.col("date") >= F.col("from_date")))))
    w = Window.partitionBy("category", "code", "w_id").orderBy("date")
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    income_ret = F.col("wan_per_nav") / 10000.0 / F.col("per_nav")
    # price = prod(1 + r), as exp(sum(ln |1 + r|)) with the sign of the
    # number of negative factors; a factor of 0 leaves the price at 0.
    factor = 1 + income_ret
    size = F.exp(F.coalesce(F.sum(F.when(factor != 0, F.log(F.abs(factor)))).over(running), F.lit(0.0)))
    negative = F.sum(F.when(factor < 0, 1).otherwise(0)).over(running) % 2 == 1
    zero = F.max((factor == 0).cast("int")).over(running) == 1
    product = F.when(zero, 0.0).when(negative, -size).otherwise(size)
    s = (s.withColumn("rn", F.row_number().over(w))
          .withColumn("ret", F.when(F.col("method") == PER_NAV,
                                    F.coalesce(F.col("per_nav") / F.lag("per_nav").over(w) - 1,
                                               F.lit(0.0)))
                       .otherwise(income_ret))
          .withColumn("price", F.when(F.col("method") == PER_NAV, F.col("per_nav"))
                      .otherwise(product)))
    peak = F.max(F.when(F.col("rn") > 1, F.col("price"))).over(running)
    peak_full = F.max("price").over(running)  # Q3 alternative: the first row counts
    return (s.withColumn("peak", peak)
             .withColumn("dd", F.when(F.col("rn") > 1, (F.col("peak") - F.col("price")) / F.col("peak"))
                         .otherwise(F.lit(0.0)))
             .withColumn("dd_full", (peak_full - F.col("price")) / peak_full))


def series_stats(s: DataFrame) -> DataFrame:
    return (s.groupBy("category", "code", "w_id")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.min_by("price", "date").alias("p_first"),
                  F.max_by("price", "date").alias("p_last"),
                  F.avg("ret").alias("r_mean"),
                  F.stddev_pop("ret").alias("r_std"),
                  F.max("dd").alias("mdd"),
                  F.max("dd_full").alias("mdd_full")))


def fund_indicators(nav: DataFrame, fund_category: DataFrame, *, categories, methods: dict,
                    lookbacks, as_of: str, funds=None, indicators=None) -> DataFrame:
    """Long result: one row per (category, fund, look-back) with every indicator.

    `nav` columns: code, date, per_nav (double), wan_per_nav (double, may be NULL
    for price-only funds)."""
    spark = nav.sparkSession
    names = list(indicators or ALL_INDICATORS)
    wins = windows_array(lookbacks, as_of)
    fl = fund_list(nav, fund_category, categories, methods, as_of, funds)
    stats = series_stats(series(nav.where(F.col("date") <= F.to_date(F.lit(as_of))), fl, wins))
    scored = stats.select("category", "code", "w_id", F.col("n").alias("n_days"),
                          *indicator_columns(names))
    grid = fl.select("category", "code", F.explode(wins).alias("_w")).select(
        "category", "code", "_w.w_id", "_w.interval", "_w.lag", "_w.lookback")
    return (grid.join(scored, ["category", "code", "w_id"], "left")
                .select("category", "code", "interval", "lag", "lookback",
                        F.coalesce("n_days", F.lit(0)).cast("bigint").alias("n_days"), *names))


def company_names(security_company: DataFrame, company: DataFrame) -> DataFrame:
    """One company name per fund code (security type prefix 059);
    the reference's unordered LIMIT 1 becomes min(name) (Q8)."""
    return (security_company.where(F.col("security_type").startswith("059"))
            .join(company, "company_code")
            .groupBy("code").agg(F.min("company_name").alias("company")))


def compare_wide(long: DataFrame, names: DataFrame, lookbacks, indicators=None) -> DataFrame:
    """A23 + J2: one row per (category, fund), one column per
    indicator_interval_lag (known list, so pivot needs no extra pass), plus the
    company name falling back to the fund code."""
    inds = list(indicators or ALL_INDICATORS)
    wins = [lookback_label(u, c) for u, c in validate_lookbacks(lookbacks)]
    cols = [f"{i}_{w}" for i in inds for w in wins]
    stacked = long.select("category", "code", F.explode(F.array(*[
        F.struct(F.concat(F.lit(i + "_"), F.col("lookback")).alias("k"), F.col(i).alias("v"))
        for i in inds])).alias("kv")).select("category", "code", "kv.k", "kv.v")
    wide = stacked.groupBy("category", "code").pivot("k", cols).agg(F.first("v"))
    return (wide.join(names, "code", "left")
                .withColumn("company", F.coalesce(F.col("company"), F.col("code")))
                .select("category", "code", "company", *cols))


def indicator_csv(long: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S12 narrow sink: one CSV folder per category x interval x lag, values
    formatted `%.08f` with blanks for NULL (F2)."""
    from tessera.functions.indicators import format_8
    cols = [c for c in ALL_INDICATORS if c in long.columns]
    (long.select("category", "interval", "lag", "code", *[format_8(F.col(c)).alias(c) for c in cols])
         .write.mode(mode).partitionBy("category", "interval", "lag").option("header", True).csv(path))
