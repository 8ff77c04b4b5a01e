"""Shared helpers for the bound queries.

Checked outputs are normalised the same way in Spark and in the SQL oracle:
bounded doubles are rounded to 6 decimals (`+ 0.0` removes -0.0); quantities
without a magnitude bound (powers such as the annual return) are additionally
cast to REAL, because rounding very large doubles is not bit-identical across
engines while the float32 cast of two doubles a few ulps apart is.  Beyond
`LARGEST` (a return of a few days raised to a year) they are shown as that.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from tessera.sources.tables import Tables

LARGEST = 1e30


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6) + F.lit(0.0)


def rf(c) -> Column:
    x = r6(c)
    return F.when(x > LARGEST, LARGEST).when(x < -LARGEST, -LARGEST).otherwise(x).cast("float")


def sql_r6(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


def sql_rf(expr: str) -> str:
    x = f"(round({expr}, 6) + 0.0)"
    return f"CAST(CASE WHEN {x} > {LARGEST} THEN {LARGEST} WHEN {x} < -{LARGEST} THEN -{LARGEST} ELSE {x} END AS REAL)"


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)
