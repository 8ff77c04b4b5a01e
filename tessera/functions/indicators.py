"""Indicator registry, name -> column expression over the per-series
aggregate columns produced by `tessera.operators.funds.series_stats`.

Aggregate inputs (all per fund x look-back window):
  n        number of prices in the window
  p_first  first price, p_last last price
  r_mean   mean of the return series, r_std population std of it
  mdd      max drawdown (peak excludes the first row, Q3)
  mdd_full max drawdown with the first row in the peak
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the indicator definitions.
TRADING_DAYS = 252.0
SHARPE_RF = 0.0
CALMAR_RF = 0.03
CALMAR_MIN_MDD = 1e-6


def annual_return() -> Column:
    """(last/first)^(252/(n+1)) - 1."""
    return F.pow(F.col("p_last") / F.col("p_first"), F.lit(TRADING_DAYS) / (F.col("n") + 1)) - 1


def annual_volatility() -> Column:
    """A10: population std of returns x sqrt(252)."""
    return F.col("r_std") * F.lit(math.sqrt(TRADING_DAYS))


def sharp_ratio() -> Column:
    """mean(excess)/std(excess) x sqrt(252); NULL when std is 0 (Q4)."""
    return F.when(F.col("r_std") != 0,
                  (F.col("r_mean") - F.lit(SHARPE_RF)) / F.col("r_std")
                  * F.lit(math.sqrt(TRADING_DAYS)))


def max_drawdown() -> Column:
    """A12 (Q3 kept: the running peak skips the first row)."""
    return F.col("mdd")


def calmar_ratio() -> Column:
    """(annual return - 0.03) / mdd, NULL when mdd <= 1e-6."""
    return F.when(F.abs(F.col("mdd")) > F.lit(CALMAR_MIN_MDD),
                  (annual_return() - F.lit(CALMAR_RF)) / F.col("mdd"))


def max_drawdown_full() -> Column:
    """A12 with the first row in the running peak (Q3 corrected): [5, 4, 4.4]
    gives 0.2.  Opt-in by name; the default set keeps the reference's value."""
    return F.col("mdd_full")


REGISTRY = {
    "annual_return": annual_return,
    "annual_volatility": annual_volatility,
    "sharp_ratio": sharp_ratio,
    "max_drawdown": max_drawdown,
    "calmar_ratio": calmar_ratio,
    "max_drawdown_full": max_drawdown_full,
}

# The reference's five indicators, in its order (the default output).
ALL_INDICATORS = ["annual_return", "annual_volatility", "sharp_ratio", "max_drawdown", "calmar_ratio"]


def indicator_columns(names=None) -> list[Column]:
    names = list(names or ALL_INDICATORS)
    unknown = [n for n in names if n not in REGISTRY]
    if unknown:
        raise ValueError(f"unknown indicators {unknown}")
    return [REGISTRY[n]().alias(n) for n in names]


def format_8(c: Column) -> Column:
    """`%.08f` text, NULL -> '' (only at the CSV edge).  format_string
    turns a NULL argument into the text 'null', so NULL is tested first."""
    return F.when(c.isNull(), F.lit("")).otherwise(F.format_string("%.8f", c))
