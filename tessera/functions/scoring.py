"""Term-scoring column arithmetic.

F7 is pinned by us (the reference delegates to a library without a formula):
  idf  = ln(N / (df + 1)) + 1
  BM25 = idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * len / avglen)), k1=1.2, b=0.75
  Bo1  = tf_set * log2((1 + f) / f) + log2(1 + f), f = cf / N
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the pinned formulas.
BM25_K1 = 1.2
BM25_B = 0.75
BURST_UNDEFINED = 3.0


def idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs / (df + 1)) + 1


def bm25(tf: Column, doc_len: Column, avg_len: Column, idf_c: Column,
         k1: float = BM25_K1, b: float = BM25_B) -> Column:
    return idf_c * tf * (k1 + 1) / (tf + k1 * (1 - b + b * doc_len / avg_len))


def bo1(tf_set: Column, cf: Column, n_docs: Column) -> Column:
    f = cf / n_docs
    return tf_set * F.log2((1 + f) / f) + F.log2(1 + f)


def sqrt_tf(freq: Column, doc_len: Column) -> Column:
    """tf = sqrt(freq / doc length)."""
    return F.sqrt(freq / doc_len)


def burst_ratio(current: Column, past_sum: Column, past_count: Column) -> Column:
    """current weight against the mean of the past periods.

    past_count counts the periods that contribute (absent term = 0.0 counts,
    a stored weight <= 0 does not).  Undefined mean and current != 0 -> 3.0;
    current = 0 -> 0; past mean 0 -> 3.0; else current / mean."""
    return (F.when((past_count == 0) & (current != 0), F.lit(BURST_UNDEFINED))
             .when(current == 0, F.lit(0.0))
             .when(past_sum == 0, F.lit(BURST_UNDEFINED))
             .otherwise(current.cast("double") * past_count / past_sum))


def log_count(x: Column) -> Column:
    """ln(1 + x)."""
    return F.log1p(x)
