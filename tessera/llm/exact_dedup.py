"""Exact dedup: two-pass Bloom filtering.

Pass 1 sets `HASHES` bits per normalised text digest in a filter of 2^b bits
and keeps the bits that two or more rows set.  Pass 2 tests every row: if one
of its bits was set by that row alone its text is unique and the row passes
straight through; only the rest is shuffled, by digest, to find the groups.

The filter has about `BITS_PER_ROW` bits per row, up to 2^`MAX_BITS`; it is
broadcast as at most 2^(MAX_BITS - 6) words of 64 bits, whatever the input.
Beyond that size more unique rows take the shuffle as well: slower, same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (bit_words, filter_width, join_to_groups, packed, text_or_empty, top_bits, with_bit,
                                without_white, written)

BITS_PER_ROW = 16
MIN_BITS, MAX_BITS = 12, 26
HASHES = 2


def digest_columns(id_col: str, text_col: str) -> dict[str, Column]:
    text = text_or_empty(text_col)
    return {"id": F.col(id_col), "digest": F.unhex(F.sha2(without_white(text), 256)),
            "n_points": F.char_length(text).cast("long"), "rid": F.monotonically_increasing_id()}


def _places(bits: int) -> list[Column]:
    return [top_bits(bits, "digest", F.lit(k)) for k in range(HASHES)]


def repeated_bits(digests: DataFrame, bits: int) -> DataFrame:
    """Pass 1: the filter bits that two or more rows set."""
    at = digests.select(F.explode(F.array(*_places(bits))).alias("at"))
    return bit_words(at.groupBy("at").agg(F.count("*").alias("n")).where("n > 1"))


def marked(digests: DataFrame, n_rows: int) -> DataFrame:
    """Pass 2: adds `maybe`, false only for rows whose text is unique."""
    bits = filter_width(n_rows, BITS_PER_ROW, MIN_BITS, MAX_BITS)
    filter_words = written(repeated_bits(digests, bits), "bloom")
    out = digests
    for k, at in enumerate(_places(bits)):
        out = with_bit(out, at, filter_words, f"_bit{k}")
    maybe = F.expr(" AND ".join(f"_bit{k}" for k in range(HASHES)))
    return out.select(*digests.columns, maybe.alias("maybe"))


def groups_of(again: DataFrame) -> DataFrame:
    """(digest, group_size, keep_id, keep_rid) of the rows that may repeat."""
    stays = F.struct((-F.col("n_points")).alias("longest"), F.col("id").isNull().alias("no_id"), "id", "rid")
    groups = again.groupBy("digest").agg(F.count("*").alias("group_size"), F.min(stays).alias("stays"))
    return groups.select("digest", "group_size", F.col("stays.id").alias("keep_id"), F.col("stays.rid").alias("keep_rid"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after deleting every character of
    `[\\x20\\x09-\\x0D]`; a null text counts as empty.  Of equal texts the row
    with the most code points in the original text stays, then the smallest
    id (a null id last), then the first row: of rows that repeat with id and
    text exactly one is kept.  An empty table gives an empty result.  Other
    columns are not read.
    """
    digests = written(docs.select(*[c.alias(k) for k, c in digest_columns(id_col, text_col).items()]), "digests")
    n = digests.count()
    rows = marked(digests, n)
    once, again = rows.where(~F.col("maybe")), rows.where("maybe")
    again = join_to_groups(again, written(groups_of(again), "copies"), "digest", "group_size", n)
    sha = F.lower(F.hex("digest")).alias("text_sha256")
    return once.select(
        F.col("id").alias("doc_id"), F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), sha,
    ).unionByName(again.select(
        F.col("id").alias("doc_id"), "keep_id", F.col("group_size").cast("long"),
        (F.col("rid") == F.col("keep_rid")).alias("kept"), sha,
    ))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `exact_dedup` keeps, with all their columns.

    The rows and digests are written once; unique texts are then read straight
    through and only the copies' row ids are joined.
    """
    table = written(packed(docs, **digest_columns(id_col, text_col)), "rows")
    rows = marked(table, table.count())
    stays = groups_of(rows.where("maybe")).select(F.col("keep_rid").alias("rid"))
    return rows.where(~F.col("maybe")).select("row.*").unionByName(
        rows.where("maybe").join(stays, "rid", "left_semi").select("row.*"))
