"""Key counting (A1, T7; Y2 map/reduce hooks).

`key_count` is one partial + final hash aggregate: keys are combined inside
each input task before the shuffle, so a key holding a third of the input
still ships one partial row per task.  `key_count_parts` reproduces the
reference's 13 sorted reducer outputs: the same key -> reducer function as its
partitioner, applied to the (already aggregated, hence small) counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_count(keys: DataFrame, key: str = "key", drop_empty: bool = False) -> DataFrame:
    """A1: count per key.  '' is its own key (Q1 corrected); empty input gives
    no rows (Q2 corrected); `drop_empty` drops '' keys."""
    k = keys.select(F.col(key).alias("key"))
    if drop_empty:
        k = k.where(F.col("key") != "")
    return k.where(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def reducer_part(key, parts: int) -> F.Column:
    """The reducer a key goes to under the reference's partitioner
    (Hadoop's key-field partitioner on the whole key): h = 31 * h + b over the
    key's UTF-8 bytes as signed bytes, part = (h & Integer.MAX_VALUE) % parts.
    Only the low 31 bits of h matter, so h is kept modulo 2^31 at each step
    (no overflow).  Runs in the JVM: hex pairs -> signed bytes -> aggregate."""
    key = F.col(key) if isinstance(key, str) else key
    pairs = F.regexp_extract_all(F.hex(F.encode(key, "UTF-8")), F.lit("(..)"), 1)
    signed = F.transform(pairs, lambda x: F.conv(x, 16, 10).cast("int") - F.when(
        F.conv(x, 16, 10).cast("int") > 127, F.lit(256)).otherwise(F.lit(0)))
    h = F.aggregate(signed, F.lit(0).cast("bigint"),
                    lambda acc, b: F.pmod(acc * 31 + b, F.lit(2 ** 31).cast("bigint")))
    return (h % parts).cast("int")


def key_count_parts(counts: DataFrame, parts: int = 13) -> DataFrame:
    """Each key in exactly the reference's reducer output `part`, keys
    sorted inside each.  The counts are already aggregated (one row per key),
    so this shuffle moves one row per key."""
    return (counts.withColumn("part", reducer_part("key", parts))
                  .repartition(parts, "part").sortWithinPartitions("part", "key"))


def write_key_counts(counts: DataFrame, path: str, parts: int = 13, mode: str = "overwrite") -> None:
    """Reducer-style text output `key\tcount`: folder `part=<p>` per reducer."""
    (key_count_parts(counts, parts)
        .select("part", F.concat_ws("\t", "key", F.col("n").cast("string")).alias("value"))
        .write.mode(mode).partitionBy("part").text(path))


def map_reduce(df: DataFrame, mapper, reducer, mapped_schema: str, out_schema: str,
               key: str = "key") -> DataFrame:
    """Y2: the reference's external mapper/reducer pair as Python callables.

    `mapper(pandas.DataFrame) -> pandas.DataFrame` runs per Arrow batch
    (mapInPandas); `reducer(pandas.DataFrame) -> pandas.DataFrame` runs per key
    group (applyInPandas).  Prefer built-in aggregates where they exist: a
    reducer group holds every row of its key."""
    def _map(batches):
        for b in batches:
            yield mapper(b)
    mapped = df.mapInPandas(_map, mapped_schema)
    return mapped.groupBy(key).applyInPandas(reducer, out_schema)
