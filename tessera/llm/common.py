"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# The white space of every word rule here: space and U+0009..U+000D.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"


_scratch: list[str] = []  # folders that `written` made and nobody has deleted


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def delete_scratch(spark: SparkSession, *in_use: DataFrame) -> None:
    """Deletes what `written` has left in the shared folder, but for the files
    that the given tables read.  For callers that have written all results they
    still need, such as the pipeline between two stages."""
    files = [f for df in in_use for f in df.inputFiles()]
    kept = []
    for path in _scratch:
        if any(path.split("://")[-1] in f for f in files):
            kept.append(path)
            continue
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _scratch[:] = kept


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """`df` written as Parquet to the shared folder and read again: cuts the
    lineage with files that survive a lost executor, and fixes the values of
    row ids.  `codec`: of the files, the session's where none is given."""
    path = scratch_path(df.sparkSession, name)
    _scratch.append(path)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """All columns of `df` inside one struct `row`, with `more` beside it, so
    that no column of the caller can clash with a working column."""
    return df.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in more.items()])


def held_out(id_col: str | Column, parts: int, part: int = 2) -> Column:
    """True where crc32(id as text) mod `parts` is `part`; a null id is not
    held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % parts == part, F.lit(False))


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def without_white(c: Column) -> Column:
    """The text without the six white-space characters (byte-wise `replace`,
    which is faster here than a regular expression)."""
    for ch in WHITE:
        c = F.replace(c, F.lit(ch), F.lit(""))
    return c


def words(c: Column) -> Column:
    """Array of the words `[^\\x20\\x09-\\x0D]+` of a non-null text."""
    return F.array_remove(F.split(c, WHITE_RUN), "")


def bound(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often and in
    whatever lambda `body` reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def join_to_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int,
                   hot_share: int = 1000) -> DataFrame:
    """`rows` inner-joined to `groups` (one row per key, with the number of
    its rows in column `size`).

    Keys with more than 1/`hot_share` of all `n_rows` rows number fewer than
    `hot_share`, so they are broadcast; in the shuffled join of the others no
    key holds more than that share.
    """
    hot = F.broadcast(groups.where(F.col(size) * hot_share > n_rows))
    cold = groups.where(F.col(size) * hot_share <= n_rows)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))


def bit_words(at: DataFrame) -> DataFrame:
    """(word, mask): the bits set at the places in column `at`."""
    bit = (F.col("at") % 64).cast("int")
    mask = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return at.groupBy(F.shiftright("at", 6).alias("word")).agg(mask.alias("mask"))


def with_bit(df: DataFrame, at: Column, filter_words: DataFrame, out: str) -> DataFrame:
    """Adds whether the bit at place `at` is set.  `filter_words` is broadcast:
    its size is bounded by the filter's width, not by the input."""
    f = F.broadcast(filter_words.select(F.col("word").alias("_word"), F.col("mask").alias("_mask")))
    bit = F.call_function("shiftright", F.coalesce("_mask", F.lit(0)), (at % 64).cast("int"))
    return df.join(f, F.shiftright(at, 6) == F.col("_word"), "left").select(
        *df.columns, (bit.bitwiseAND(F.lit(1)) == 1).alias(out))


def top_bits(bits: int, *columns: Column | str) -> Column:
    """A place in a filter of 2^bits bits for the values of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits)


def filter_width(n_rows: int, per_row: int = 16, least: int = 12, most: int = 26) -> int:
    """log2 of the bits of a filter for `n_rows` keys, `most` at most."""
    return max(least, min(most, (max(1, n_rows) * per_row - 1).bit_length()))


def rows_with(table: DataFrame, key: str, wanted: DataFrame, n_wanted: int, how: str) -> DataFrame:
    """`table` semi- or anti-joined (`how`) to the distinct long keys
    `wanted`.  A broadcast filter sends only the rows that may match to the
    shuffle, so wide rows without a match pass straight through."""
    bits = filter_width(n_wanted)
    words = written(bit_words(wanted.select(top_bits(bits, key).alias("at")).distinct()), "filter")
    marked = with_bit(table, top_bits(bits, key), words, "_maybe")
    maybe = marked.where("_maybe").drop("_maybe").join(wanted.select(key), key, how)
    return maybe if how == "left_semi" else marked.where(~F.col("_maybe")).drop("_maybe").unionByName(maybe)


def in_groups(batches, key: str):
    """Arrow tables of one key each, from record batches sorted by `key` (a
    long).  Only the group at hand is held besides a batch."""
    import numpy as np
    import pyarrow as pa

    rest = None
    for b in batches:
        t = pa.Table.from_batches([b]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([b])])
        if not t.num_rows:
            continue
        keys = t.column(key).to_numpy()
        cuts = np.flatnonzero(np.diff(keys)) + 1
        for start, end in zip([0, *cuts[:-1]], cuts):
            yield t.slice(start, end - start)
        rest = t.slice(cuts[-1] if len(cuts) else 0)
    if rest is not None and rest.num_rows:
        yield rest
