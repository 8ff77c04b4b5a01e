"""Hot terms, burst detection and hot-document ranking
(A3 A4 A5 A6 A7 W4 W8 F5 P7 P8 P9 P10 X16 J20 J23 T1 T2 S13).

All scoring is column arithmetic over `doc_terms` aggregates.  Every per-group
step is an aggregate with map-side combine (never a window over a whole
period), every window is bounded by construction:
  * per-term burst windows hold one row per half-day period (calendar bound);
  * per-document windows hold one document's terms.
Word lists (stop, black, white) are small job parameters and are broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scoring import burst_ratio
from tessera.functions.text import is_number
from tessera.operators import terms as T
from tessera.operators.report import global_row_index
from tessera.sources.store import names_in

# Fixed values of the reference jobs.
HOT_TERM_LIMIT = 100
# Vocabulary limits of the reference jobs, to be asked for: the operators score
# every term unless given one.
KEY_TERMS = 10_000
DISTINCTIVE_TERMS = 10_000
TFPDF_TERMS = 100_000
LOOKBACK_PERIODS = 30
TFPDF_DAYS = 10
WHITELIST_DEFAULT_SCORE = 2.0


# ------------------------------------------------------------------ filters

def drop_numbers(df: DataFrame, col: str = "term") -> DataFrame:
    """P7."""
    return df.where(~is_number(F.col(col)))


def drop_hot_stop_words(df: DataFrame, stop_words: DataFrame | None, col: str = "term") -> DataFrame:
    """Drop a term equal to, or contained in, any hot stop word: an equi
    join with the substrings of the (short) stop words."""
    if stop_words is None:
        return df
    w = stop_words.where(F.col("word") != "").select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("_at"))
    inside = w.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - F.col("_at") + 1),
                                            lambda n: F.substring(F.col("word"), F.col("_at"), n))).alias("_sub")).distinct()
    return df.join(inside, F.col(col) == F.col("_sub"), "left_anti")


def term_filters(df: DataFrame, stop_words: DataFrame | None) -> DataFrame:
    return drop_hot_stop_words(drop_numbers(df), stop_words)


# ------------------------------------------------------------- A3 / A4 / A5

def hot_term_weights(dt: DataFrame, corpus_stats: DataFrame | None, n_corpus: DataFrame, *,
                     by=(), stop_words: DataFrame | None = None,
                     key_limit: int | None = None) -> DataFrame:
    """A3: weight = mean over the window's documents of sqrt(tf/len) * idf * df/N,
    restricted to the window's top `key_limit` key terms if given, kept when > 0, then
    P7 and P8.  `by` computes every window (e.g. every period) in one job.

    dt: doc_terms of the window documents (with the `by` columns);
    corpus_stats / n_corpus: corpus-wide term_stats and document count; without
    the former the windows are the whole corpus, a document being in one."""
    by = list(by)
    ws = T.term_stats(dt, by)
    n_win = dt.select(*by, "doc_id").distinct().groupBy(*by).agg(F.count(F.lit(1)).alias("n_win"))
    if key_limit is not None:
        corpus_stats = T.term_stats(dt) if corpus_stats is None else corpus_stats
        ws = ws.join(T.key_terms(ws, corpus_stats, n_corpus, key_limit, by), by + ["term"], "left_semi")
    s = T.with_idf(ws, corpus_stats, n_corpus, by)
    s = s.join(n_win, by) if by else s.withColumn("n_win", n_win.select("n_win").scalar())
    s = s.withColumn("weight", F.col("s_sqrt_tf") * F.col("idf") * (F.col("df") / F.col("n_win"))
                     / F.col("n_win"))
    return term_filters(s.where(F.col("weight") > 0).select(*by, "term", "weight"), stop_words)


def hot_term_weights_pre(dt: DataFrame, corpus_stats: DataFrame, n_corpus: DataFrame,
                         n_window: DataFrame, *, stop_words: DataFrame | None = None,
                         limit: int | None = None) -> DataFrame:
    """A4 (older variant): terms chosen corpus-wide (top `limit` by cf*ln(N/df));
    tf normalised by the document's total over the chosen terms only; N is the
    number of window documents (with or without terms)."""
    sel = dt if limit is None else dt.join(T.distinctive_terms(corpus_stats, n_corpus, limit), "term", "left_semi")
    w = Window.partitionBy("doc_id")  # one document's terms: bounded
    sel = sel.withColumn("len_sel", F.sum("tf").over(w))
    s = (sel.groupBy("term")
            .agg(F.count(F.lit(1)).alias("df_win"),
                 F.sum(F.sqrt(F.col("tf") / F.col("len_sel"))).alias("s_sqrt_tf")))
    s = T.with_idf(s, corpus_stats, n_corpus).withColumn("n_win", n_window.select("n_docs").scalar())
    s = s.withColumn("weight", F.col("s_sqrt_tf") * F.col("idf") * (F.col("df_win") / F.col("n_win"))
                     / F.col("n_win"))
    return term_filters(s.where(F.col("weight") > 0).select("term", "weight"), stop_words)


def tfpdf_weights(dt: DataFrame, channel_sizes: DataFrame, corpus_stats: DataFrame,
                  n_corpus: DataFrame, limit: int | None = None) -> DataFrame:
    """A5: TF-PDF per channel.  dt carries the channel column `channel`;
    channel_sizes = (channel, n_docs) over the window documents.
    weight = sum_c F_c / ||F||_2 * exp(n_c / N_c)  (absent channels add 0)."""
    sel = dt if limit is None else dt.join(T.distinctive_terms(corpus_stats, n_corpus, limit), "term", "left_semi")
    per = (sel.groupBy("term", "channel")
             .agg(F.sum("tf").alias("f"), F.count(F.lit(1)).alias("n")))
    per = per.join(channel_sizes.select("channel", F.col("n_docs").alias("n_c")), "channel")
    agg = per.groupBy("term").agg(F.sum(F.col("f") * F.col("f")).alias("f2"),
                                  F.sum(F.col("f") * F.exp(F.col("n") / F.col("n_c"))).alias("fe"))
    return agg.select("term", F.when(F.col("f2") > 0, F.col("fe") / F.sqrt("f2"))
                      .otherwise(F.lit(0.0)).alias("weight"))


def tfpdf_daily(dt: DataFrame, doc_days: DataFrame, days: int = TFPDF_DAYS) -> DataFrame:
    """A5 with its look-back, every day at once: (day, term, weight) with the
    TF-PDF of the documents of the `days` days that end with `day`.

    dt: (doc_id, day, channel, term, tf); doc_days: (doc_id, day, channel) of
    all documents.  Daily partial counts per (term, channel) enter the window
    on their day and leave it `days` days later; running sums over these two
    events give every window's counts, so no day's documents are read more
    than once.  A key's events number two a day at most.  Days are those that
    have documents in their window; a term is shown while it has some."""
    def sliding(daily: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
        enter = daily.select(*keys, "day", *sums)
        leave = daily.select(*keys, F.date_add("day", days).alias("day"), *[(-F.col(c)).alias(c) for c in sums])
        events = enter.unionByName(leave).groupBy(*keys, "day").agg(*[F.sum(c).alias(c) for c in sums])
        by = Window.partitionBy(*keys).orderBy("day")
        run = events.select(*keys, "day", *[F.sum(c).over(by).alias(c) for c in sums], F.lead("day").over(by).alias("_next"))
        # between two events nothing changes: a row for each day of the stretch
        return run.where(F.col(sums[-1]) > 0).select(
            *keys, *sums, F.explode(F.sequence("day", F.date_sub("_next", 1))).alias("day"))

    daily = dt.groupBy("term", "channel", "day").agg(F.sum("tf").alias("f"), F.count(F.lit(1)).alias("n"))
    sizes = sliding(doc_days.groupBy("channel", "day").agg(F.count(F.lit(1)).alias("n_c")), ["channel"], ["n_c"])
    last = doc_days.agg(F.max("day").alias("d")).select("d").scalar()
    per = sliding(daily, ["term", "channel"], ["f", "n"]).join(sizes, ["channel", "day"]).where(F.col("day") <= last)
    agg = per.groupBy("day", "term").agg(F.sum(F.col("f") * F.col("f")).alias("f2"),
                                         F.sum(F.col("f") * F.exp(F.col("n") / F.col("n_c"))).alias("fe"))
    return agg.select("day", "term", F.when(F.col("f2") > 0, F.col("fe") / F.sqrt("f2")).otherwise(F.lit(0.0)).alias("weight"))


def doc_scores(dt: DataFrame, weights: DataFrame, docs: DataFrame, by=()) -> DataFrame:
    """Document score = sum of the weights of the distinct terms present;
    documents without any weighted term score 0 (left join from `docs`).
    T4 (docs by score, descending) is left to the reader: a global sort is a
    range shuffle of every row, so it is only added where the output needs it
    (`ranked_documents`)."""
    by = list(by)
    # the weights first: where few terms have one, the others are neither told apart nor shuffled
    weights = weights.groupBy(*by, "term").agg(F.sum("weight").alias("weight"))
    present = dt.where(F.col("tf") > 0).select(*by, "doc_id", "term").join(weights, by + ["term"]).distinct()
    s = present.groupBy(*by, "doc_id").agg(F.sum("weight").alias("score"))
    return (docs.select(*by, "doc_id").join(s, by + ["doc_id"], "left")
                .withColumn("score", F.coalesce("score", F.lit(0.0))))


def max_normalise(df: DataFrame, col: str, by=()) -> DataFrame:
    """Divide by the group maximum (1 when the maximum is 0).  The maximum
    is a grouped aggregate joined back (one row per group), not a window, so a
    hot group is never gathered into one task."""
    by = list(by)
    m = df.groupBy(*by).agg(F.max(col).alias("_max"))
    j = df.join(m, by) if by else df.withColumn("_max", m.select("_max").scalar())
    return j.withColumn(col + "_norm", F.col(col) / F.when(F.col("_max") == 0, F.lit(1.0))
                        .otherwise(F.col("_max"))).drop("_max")


# ------------------------------------------------------------- W4 / F5 / W8

def latest_per_period(history: DataFrame) -> DataFrame:
    """When a period was written more than once keep its latest load."""
    if "loaded_at" not in history.columns:
        return history
    last = history.groupBy("period_end").agg(F.max("loaded_at").alias("loaded_at"))
    return history.join(last, ["period_end", "loaded_at"], "left_semi")


def burst_terms(history: DataFrame, periods: DataFrame, *, stop_words: DataFrame | None = None,
                lookback: int = LOOKBACK_PERIODS, limit: int | None = HOT_TERM_LIMIT) -> DataFrame:
    """W4 + F5 for every period at once.

    history: (period_end, term, weight) with weights stored at 6 decimals (Q24);
    periods:  every period of the history, including periods without terms.
    For each term of period p: past = the previous `lookback` periods; absent
    term counts as 0.0; a stored weight <= 0 is not counted at all."""
    pidx = periods.select("period_end").distinct().withColumn(
        "p_idx", F.row_number().over(Window.orderBy("period_end")) - 1)  # calendar-sized
    # Stored weights have 6 decimals (Q24); keep them as exact micro-units so
    # the past sums (and hence ties between ratios) do not depend on the order
    # of floating-point additions.
    h = latest_per_period(history).select(
        "period_end", "term", F.round(F.col("weight") * 1_000_000).cast("long").alias("wm"))
    h = h.join(F.broadcast(pidx), "period_end")  # bounded: one row per half-day
    w = Window.partitionBy("term").orderBy("p_idx").rangeBetween(-lookback, -1)
    h = (h.withColumn("past_sum", F.coalesce(F.sum(F.when(F.col("wm") > 0, F.col("wm"))).over(w), F.lit(0)))
          .withColumn("past_nonpos", F.count(F.when(F.col("wm") <= 0, 1)).over(w))
          .withColumn("n_past", F.least(F.col("p_idx"), F.lit(lookback))))
    h = h.withColumn("ratio", burst_ratio(F.col("wm"), F.col("past_sum"),
                                          F.col("n_past") - F.col("past_nonpos")))
    h = h.withColumn("w", F.col("wm") / 1_000_000)
    out = term_filters(h.select("period_end", "term", F.col("w").alias("weight"), "ratio"), stop_words)
    if limit is None:
        return out
    rk = Window.partitionBy("period_end").orderBy(F.desc("ratio"), F.asc("term"))
    return out.withColumn("rank", F.row_number().over(rk)).where(F.col("rank") <= limit)


# -------------------------------------------------------------- P9 / P10 / X16

def _with_list(docs: DataFrame, words: DataFrame, *cols) -> DataFrame:
    """`docs` with `_list`: the words of a list (a job parameter) that are not
    blank, as one array of (word, *cols), so that "word inside title" is looked
    at where the title lies: a title is read once a word, in time linear in its
    length, and neither exploded nor shuffled."""
    entries = words.where(F.col("word") != "").select(F.struct("word", *cols).alias("e")).distinct()
    return docs.withColumn("_list", entries.agg(F.collect_list("e").alias("l")).select("l").scalar())


def whitelist_score(docs: DataFrame, white: DataFrame, title: str = "title") -> DataFrame:
    """P10: `white_score` = max score of the whitelisted words inside the title
    (Q11: max instead of dict order), 0 when none."""
    listed = _with_list(docs, white, F.coalesce(F.col("score"), F.lit(WHITELIST_DEFAULT_SCORE)).alias("score"))
    inside = F.filter("_list", lambda w: F.contains(F.col(title), w["word"]))
    best = F.array_max(F.transform(inside, lambda w: w["score"]))
    return listed.withColumn("white_score", F.coalesce(best, F.lit(0.0))).drop("_list")


def blacklisted(docs: DataFrame, black: DataFrame, title: str = "title") -> DataFrame:
    """`black` flag when any blacklisted word is inside the title (blank
    words dropped, Q12)."""
    inside = F.exists("_list", lambda w: F.contains(F.col(title), w["word"]))
    return _with_list(docs, black).withColumn("black", F.coalesce(inside, F.lit(False))).drop("_list")


def ranked_documents(scored: DataFrame, score: str = "score") -> DataFrame:
    """T4: documents by score descending, ties by id, with their `position`
    (from 0) in a range-partitioned order."""
    return global_row_index(scored, [F.desc(score), F.asc("doc_id")]).withColumnRenamed("row_index", "position")


def rank_hot_documents(docs: DataFrame, dt: DataFrame, burst: DataFrame, *, white: DataFrame,
                       black: DataFrame, by=("period_end",)) -> DataFrame:
    """Hot score = sum of burst ratios of the terms present (A6), max
    normalised per window (A7), plus sentiment; whitelist replaces the score,
    blacklist forces -1.  docs: (by..., doc_id, title, sentiment)."""
    by = list(by)
    hot = doc_scores(dt, burst.select(*by, "term", F.col("ratio").alias("weight")), docs, by)
    hot = max_normalise(hot.withColumnRenamed("score", "hotscore"), "hotscore", by)
    d = blacklisted(whitelist_score(docs, white), black).select(*by, "doc_id", "sentiment", "white_score", "black")
    d = d.join(hot, by + ["doc_id"])  # without the titles
    score = (F.when(F.col("black"), F.lit(-1.0))
              .when(F.col("white_score") != 0, F.col("white_score"))
              .otherwise(F.col("hotscore_norm") + F.coalesce(F.col("sentiment"), F.lit(0.0))))
    return d.select(*by, "doc_id", score.alias("score"), "hotscore")


# ---------------------------------------------------------- J20 / J23 / S13

def hot_writeback(source: DataFrame, ranked: DataFrame, prefix: str, id_col: str) -> DataFrame:
    """Write the hot score back to the rows of one source table
    (prefix N or W; B is skipped, Q13).  Rows without a new score keep `hot`."""
    if prefix not in ("N", "W"):
        raise ValueError("only N and W sources take a hot score")
    new = (ranked.where(F.substring("doc_id", 1, 1) == prefix)
                 .select(F.substring("doc_id", 2, 1 << 30).cast("bigint").alias(id_col),
                         F.col("score").alias("_new_hot")))
    new = new.groupBy(id_col).agg(F.max("_new_hot").alias("_new_hot"))
    hot = F.col("hot") if "hot" in source.columns else F.lit(None).cast("double")
    return (source.join(new, id_col, "left")
                  .withColumn("hot", F.coalesce(F.col("_new_hot"), hot)).drop("_new_hot"))


class HistoryLog:
    """S13 as an append-only log: `<root>/period=<period end>/load=<n>`, one
    folder a period and load.  The newest period is read from the folder names,
    not from the rows; a period written again gets a later load, and readers
    take the latest one (W8)."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def periods(self) -> list[str]:
        return [n.split("=", 1)[1] for n in names_in(self.spark, self.root) if n.startswith("period=")]

    def newest(self) -> str | None:
        """The newest period, `yyyyMMddHHmm`."""
        return max(self.periods(), default=None)

    def append(self, rows: DataFrame, again: bool = False) -> None:
        """The periods of (period_end, term, weight) rows that are newer
        than the newest recorded one; with `again` all of them, as a new load."""
        rows = rows.withColumn("period", F.date_format("period_end", "yyyyMMddHHmm"))
        newest = self.newest()
        if newest is not None and not again:
            rows = rows.where(F.col("period") > newest)
        load = 1 + max((int(n.split("=", 1)[1]) for p in self.periods() for n in names_in(self.spark, f"{self.root}/period={p}") if n.startswith("load=")), default=0)
        rows.withColumn("load", F.lit(load)).hint("rebalance", "period").write.mode("append").partitionBy("period", "load").parquet(self.root)

    def read(self, newest: int | None = None) -> DataFrame:
        """The latest load of every period (or of the `newest` last ones)."""
        folders = []
        for p in sorted(self.periods())[-newest if newest else None:]:
            loads = [n for n in names_in(self.spark, f"{self.root}/period={p}") if n.startswith("load=")]
            folders.append(f"{self.root}/period={p}/" + max(loads, key=lambda n: int(n.split("=", 1)[1])))
        schema = "period_end timestamp, term string, weight double"
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)


def append_newer(history: DataFrame, new_rows: DataFrame) -> DataFrame:
    """The rows of periods newer than the last recorded period."""
    last = history.agg(F.max("period_end").alias("_last"))
    return (new_rows.withColumn("_last", last.select("_last").scalar())
                    .where(F.col("_last").isNull() | (F.col("period_end") > F.col("_last")))
                    .drop("_last"))


def history_lines(history: DataFrame) -> DataFrame:
    """S13 text form: `period\\tterm:%.06f ...`, terms by weight desc.  A line
    holds one period's terms, bounded by the key-term cap."""
    items = F.array_sort(F.collect_list(F.struct((-F.col("weight")).alias("k"), F.col("term"),
                                                 F.col("weight"))))
    return (history.groupBy("period_end").agg(items.alias("items"))
                   .select(F.concat_ws("\t", F.date_format("period_end", "yyyy-MM-dd HH:mm"),
                                       F.array_join(F.transform("items", lambda s: F.format_string(
                                           "%s:%.6f", s["term"], s["weight"])), " ")).alias("value")))
