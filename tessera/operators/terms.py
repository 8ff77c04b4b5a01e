"""Term vectors and corpus statistics.

`doc_terms` is the shared forward index: one row per (document, term) with the
term frequency and the document length.  A document's tokens are counted within
its row, so nothing is shuffled.  Whole texts are tokenised (no prefixes); the
tokenizer runs in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scoring import bo1, idf
from tessera.functions.text import tokens

SMALL_K = 1000  # up to which Spark limits the rows of a group before it shuffles them
SCORE_BINS = 4096  # bins of a score's logarithm per unit
PREFIX = 4  # characters of a term that tell tied rows apart in the second histogram


def term_counts(toks) -> Column:
    """The distinct tokens of an array with their counts, as an array of
    (term, tf) structs: the array is sorted and cut into runs within its row,
    so counting a document's terms needs no shuffle.  NULL without tokens."""
    def runs(s):
        n = F.size(s)
        starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        cut = lambda b: F.transform(b, lambda p, k: F.struct(
            F.get(s, p).alias("term"), (F.coalesce(F.get(b, k + 1), n) - p).cast("long").alias("tf")))
        return F.transform(F.array(starts), cut)[0]  # arrays of one: each is worked out once
    return F.when(F.size(toks) > 0, F.transform(F.array(F.sort_array(toks)), runs)[0])


def doc_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "content",
              keep=(), field: str | None = None, lower: bool = True, stop_words=None,
              dictionary: DataFrame | None = None) -> DataFrame:
    """X6 (+A2 length): (doc_id, term, tf, doc_len, *keep), a document being a
    row.  Documents without any token have no rows (the reference drops docs
    without a vector).  With a user `dictionary` (column `word`), Han text is
    cut by forward maximum matching (`operators.segment`)."""
    keep = list(keep)
    if dictionary is None:
        d = docs.select(F.col(id_col).alias("doc_id"), *keep,
                        tokens(F.col(text_col), lower, stop_words).alias("toks"))
    else:
        from tessera.operators.segment import segment
        seg = segment(docs, dictionary, id_col, text_col, lower=lower)
        stops = list(stop_words or [])
        seg = seg.select("doc_id", F.filter("toks", lambda x: ~x.isin(*stops)).alias("toks") if stops
                         else F.col("toks"))
        d = docs.select(F.col(id_col).alias("doc_id"), *keep).join(seg, "doc_id")
    out = (d.select("doc_id", F.size("toks").alias("doc_len"), *keep, F.explode(term_counts(F.col("toks"))).alias("t"))
            .select("doc_id", "doc_len", *keep, "t.term", "t.tf"))
    if field is not None:
        out = out.withColumn("field", F.lit(field))
    return out


def term_stats(dt: DataFrame, by=()) -> DataFrame:
    """A2: per term document frequency, collection frequency and the sum of
    sqrt(tf/len) (F6), optionally per group (e.g. publication period)."""
    by = list(by)
    return (dt.groupBy(*by, "term")
              .agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"),
                   F.sum(F.sqrt(F.col("tf") / F.col("doc_len"))).alias("s_sqrt_tf")))


def doc_count(docs: DataFrame, by=()) -> DataFrame:
    return docs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_docs"))


def top_terms(scored: DataFrame, k: int, score: str = "score", by=()) -> DataFrame:
    """The k best terms (ties: larger term first, as a max-heap of
    (score, term) pairs yields them).  Small k: top-k per task before the
    shuffle.  Larger k, for which Spark would gather whole groups: only the
    rows above a cut-off that histograms give."""
    by = list(by)
    if k > SMALL_K:
        scored = above_cut(scored, k, score, by)
    best = [F.desc(score), F.desc("term")]
    if not by:
        return scored.orderBy(*best).limit(k)
    w = Window.partitionBy(*by).orderBy(*best)
    return scored.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k).drop("_rk")


def above_cut(scored: DataFrame, k: int, score: str, by) -> DataFrame:
    """The rows of every group from which its k best by (score, term) come: k
    and the rest of the last bin at most.

    Two histograms find the cut-off: bins of the score, counted from the top
    until they hold k rows, then, within the bin where that happens, the exact
    scores and first characters of the terms (many rare terms tie).  Bins are
    combined in the map tasks, so no task sees a group's rows and nothing is
    sorted; the rows that stay are ranked exactly."""
    groups = {f"_g{i}": c for i, c in enumerate(by)}
    x = F.coalesce(F.col(score).cast("double"), F.lit(float("-inf")))
    rows = scored.withColumn("_bin", F.signum(x) * F.floor(F.log1p(F.abs(x)) * SCORE_BINS).cast("double"))
    rows = rows.withColumn("_bin", F.when(F.col("_bin").isNull() | (x == float("-inf")), F.lit(float("-inf"))).otherwise(F.col("_bin")))
    rows = rows.withColumn("_fine", F.struct(x.alias("s"), F.substring("term", 1, PREFIX).alias("p")))
    same = lambda cut: [F.col(c).eqNullSafe(F.col(f"{cut}.{g}")) for g, c in groups.items()]  # noqa: E731  null is a group too

    def cut_off(binned: DataFrame, order: str, taken) -> DataFrame:
        """Per group: the last bin that is needed, and the rows before it."""
        down = Window.partitionBy(*groups).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = F.sum("_n").over(down) - F.col("_n") + taken
        last = binned.withColumn("_before", before).where(F.col("_before") < k)
        return last.groupBy(*groups).agg(F.min(order).alias("_cut"), F.max("_before").alias("_taken"))

    named = [F.col(c).alias(g) for g, c in groups.items()]
    coarse = cut_off(rows.groupBy(*named, "_bin").agg(F.count(F.lit(1)).alias("_n")), "_bin", F.lit(0)).alias("c")
    # a row a group: the scored rows are not shuffled for it.  No bin is null; said with coalesce and <=>, as Spark
    # would else check the whole score again inside the joins below, in a method too long to be compiled
    rows = rows.join(F.broadcast(coarse), same("c") or F.lit(True)).select(
        *scored.columns, "_bin", "_fine", F.col("_cut").alias("_at"), F.col("_taken").alias("_had")).where("coalesce(_bin >= _at, false)")
    tied = rows.where("_bin <=> _at").groupBy(*named, "_fine").agg(F.count(F.lit(1)).alias("_n"), F.max("_had").alias("_had"))
    fine = cut_off(tied, "_fine", F.col("_had")).alias("f")
    rows = rows.join(F.broadcast(fine), same("f") or F.lit(True))
    return rows.where(F.coalesce((F.col("_bin") > F.col("_at")) | (F.col("_fine") >= F.col("_cut")), F.lit(False))).select(*scored.columns)


def distinctive_terms(stats: DataFrame, n_docs: DataFrame, k: int) -> DataFrame:
    """T3 corpus-wide: top k by cf * ln(N / df) (N = documents of the corpus)."""
    n = n_docs.select("n_docs").scalar()  # one value, computed once, no join
    s = stats.withColumn("score", F.col("cf") * F.log(n / F.col("df")))
    return top_terms(s, k).select("term")


def key_terms(window_stats: DataFrame, corpus_stats: DataFrame, n_docs: DataFrame, k: int,
              by=()) -> DataFrame:
    """T3 for a document set: Bo1 expansion score of each term of the set
    (tf_set = frequency in the set, f = corpus frequency / corpus size)."""
    by = list(by)
    s = (window_stats.select(*by, "term", F.col("cf").alias("tf_set"))
         .join(corpus_stats.select("term", F.col("cf").alias("cf_all")), "term"))
    s = s.withColumn("score", bo1(F.col("tf_set"), F.col("cf_all"), n_docs.select("n_docs").scalar()))
    return top_terms(s, k, by=by).select(*by, "term")


def with_idf(stats: DataFrame, corpus_stats: DataFrame | None, n_docs: DataFrame, by=()) -> DataFrame:
    """F7 idf from corpus-wide df and N.  Without `corpus_stats` the windows
    `by` of `stats` are the corpus, a document being in one of them: a term's
    df are added up (a row a window), and the index is not read again."""
    if corpus_stats is not None:
        s = stats.join(corpus_stats.select("term", F.col("df").alias("df_all")), "term")
    else:
        s = stats.withColumn("df_all", F.sum("df").over(Window.partitionBy("term")) if by else F.col("df"))
    return s.withColumn("idf", idf(n_docs.select("n_docs").scalar(), F.col("df_all")))


def top_tags(dt: DataFrame, corpus_stats: DataFrame, n_docs: DataFrame, n: int = 3) -> DataFrame:
    """The n best terms of each document by tf * idf (ties: term)."""
    s = with_idf(dt, corpus_stats, n_docs).withColumn("score", F.col("tf") * F.col("idf"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), F.asc("term"))
    return (s.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
             .select("doc_id", "rank", "term", "score"))
