"""Calendars, work lists and input health.

Calendars are generated with `sequence` + `explode` on the executors; the
only driver input is the pair of bounds.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.dates import day_sequence, half_day_period_end, hour_sequence, is_am_period


def days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every date from start to end, both inclusive (`YYYYmmdd` or ISO)."""
    s = F.to_date(F.lit(start), "yyyyMMdd") if len(start) == 8 else F.to_date(F.lit(start))
    e = F.to_date(F.lit(end), "yyyyMMdd") if len(end) == 8 else F.to_date(F.lit(end))
    return spark.range(1).select(F.explode(day_sequence(s, e)).alias("day"))


def hours(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every hour from start to end (`YYYYmmddHH`), inclusive."""
    s = F.to_timestamp(F.lit(start), "yyyyMMddHH")
    e = F.to_timestamp(F.lit(end), "yyyyMMddHH")
    return spark.range(1).select(F.explode(hour_sequence(s, e)).alias("hour")) \
        .withColumn("hour_key", F.date_format("hour", "yyyyMMddHH"))


def hours_between(bounds: DataFrame) -> DataFrame:
    """X2 over data-derived bounds: `bounds` has one row (start, end) timestamps."""
    return bounds.select(F.explode(hour_sequence(F.date_trunc("hour", "start"),
                                                 F.date_trunc("hour", "end"))).alias("hour")) \
        .withColumn("hour_key", F.date_format("hour", "yyyyMMddHH"))


def half_day_periods(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Tag each row with the end of its half-day period and the AM flag."""
    return (df.withColumn("period_end", half_day_period_end(F.col(ts)))
              .withColumn("am", is_am_period(F.col("period_end"))))


def periods_with_overlap(df: DataFrame, ts: str = "ts", overlap_seconds: int = 2400) -> DataFrame:
    """F16 daily-job form: a row also belongs to the *next* period when it lies
    within `overlap_seconds` before that period's start (the job re-reads that
    margin).  Rows explode into at most two periods."""
    own = half_day_period_end(F.col(ts))
    shifted = half_day_period_end(F.col(ts) + F.expr(f"interval {overlap_seconds} seconds"))
    return (df.withColumn("period_end", F.explode(F.array_distinct(F.array(own, shifted))))
              .withColumn("am", is_am_period(F.col("period_end"))))


def url_worklist(days_df: DataFrame, template: str, first_page: int, last_page: int) -> DataFrame:
    """Page x day URL work list (`{date}` and `{page}` placeholders in
    `template`).  Nothing is fetched; the output is a table."""
    pages = F.explode(F.sequence(F.lit(first_page), F.lit(last_page))).alias("page")
    fmt = template.replace("{date}", "%1$s").replace("{page}", "%2$d")
    return (days_df.select("day", pages)
                   .withColumn("url", F.format_string(fmt, F.date_format("day", "yyyyMMdd"), F.col("page"))))


def partition_health(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """For each expected partition key, `missing` (no data), `empty`
    (present with zero bytes) or `ok`, with row and byte counts.

    `observed` has (key, bytes) per row/file; it is aggregated before the join,
    so the join input is one row per partition."""
    agg = observed.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.sum("bytes").cast("bigint").alias("n_bytes"))
    return (expected.join(agg, key, "left")
                    .select(key,
                            F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                            F.coalesce("n_bytes", F.lit(0)).cast("bigint").alias("n_bytes"),
                            F.when(F.col("n_rows").isNull(), "missing")
                             .when(F.coalesce("n_bytes", F.lit(0)) <= 0, "empty")
                             .otherwise("ok").alias("status")))


def file_health(spark: SparkSession, expected: DataFrame, root: str, key: str = "part") -> DataFrame:
    """S5 over a directory tree `root/<key>/files`: `missing` when the
    partition directory does not exist, `empty` when it exists with no bytes,
    else `ok`.  File sizes come from the `binaryFile` listing metadata
    (content is not read); Spark file sources yield no row for a zero-length
    file, so directory existence comes from one glob of `root/*` - partition
    metadata, bounded by the number of partitions, as Spark's own file index
    lists it."""
    base = root.rstrip("/")
    jvm = spark.sparkContext._jvm
    glob = jvm.org.apache.hadoop.fs.Path(base + "/*")
    fs = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    present = [st.getPath().getName() for st in (fs.globStatus(glob) or []) if st.isDirectory()]
    dirs = spark.createDataFrame([(n, True) for n in present], f"{key} string, _dir boolean")
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
               .select(F.col("path"), F.col("length").alias("bytes")))
    observed = listing.withColumn(key, F.regexp_extract("path", rf"{re.escape(base)}/([^/]+)/", 1)) \
        .where(F.col(key) != "")
    agg = observed.groupBy(key).agg(F.count(F.lit(1)).alias("n_files"), F.sum("bytes").alias("n_bytes"))
    return (expected.join(agg, key, "left").join(dirs, key, "left")
                    .select(key, F.coalesce("n_files", F.lit(0)).cast("bigint").alias("n_files"),
                            F.coalesce("n_bytes", F.lit(0)).cast("bigint").alias("n_bytes"),
                            F.when(F.col("n_files").isNull() & F.col("_dir").isNull(), "missing")
                             .when(F.coalesce("n_bytes", F.lit(0)) <= 0, "empty").otherwise("ok").alias("status")))
