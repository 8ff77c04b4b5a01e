"""X4 for CJK text: forward maximum matching against a user dictionary.

The reference cuts Chinese text with a word segmenter loaded with a user
dictionary (bond and company short names, S20).  Here the cut is a plan of
joins and higher-order functions, all in the JVM:

 1. every token of the default analyser is split into runs of Han characters
    and other runs (other runs stay whole tokens);
 2. each Han run explodes into its candidate words: every start position and
    every length up to the longest dictionary word;
 3. a semi join with the dictionary keeps the candidates that are words (AQE
    broadcasts the dictionary when it is small, otherwise both sides shuffle
    on the word) and a grouped max gives the longest word at each position;
 4. `aggregate` over the positions of the run is the greedy scan: at the
    next uncut position take the longest word there, or one character;
 5. the pieces are put back in text order per document.

No dictionary or text passes through the driver; the longest word length is
a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import tokens

# Fixed value: a run of Han characters (Java regex script class).
HAN_RUN = r"(\p{IsHan}+|[^\p{IsHan}]+)"


def segment(docs: DataFrame, dictionary: DataFrame, id_col: str = "doc_id",
            text_col: str = "content", word_col: str = "word", lower: bool = True,
            stop_words=None) -> DataFrame:
    """(doc_id, toks): the default analyser's tokens with every run of Han
    characters cut by forward maximum matching on `dictionary`.  Documents
    without any token have no row."""
    words = dictionary.select(F.col(word_col).alias("word")).where(F.length("word") > 1).distinct()
    max_len = words.agg(F.max(F.length("word")).alias("m")).select(F.coalesce("m", F.lit(1))).scalar()

    t = docs.select(F.col(id_col).alias("doc_id"),
                    F.posexplode(tokens(F.col(text_col), lower, stop_words)).alias("tpos", "tok"))
    pieces = t.select("doc_id", "tpos", F.posexplode(
        F.regexp_extract_all("tok", F.lit(HAN_RUN), 1)).alias("ppos", "piece"))
    is_run = F.col("piece").rlike(r"^\p{IsHan}{2,}$")
    runs = pieces.where(is_run)
    plain = pieces.where(~is_run).select("doc_id", "tpos", "ppos", F.lit(0).alias("k"),
                                         F.col("piece").alias("token"))

    # 2 + 3: candidates (start i, length l), longest dictionary word per start
    n = F.length("piece")
    cand = (runs.select("doc_id", "tpos", "ppos", "piece",
                        F.explode(F.sequence(F.lit(0), n - 2)).alias("i"))
                .select("*", F.explode(F.sequence(
                    F.lit(2), F.greatest(F.lit(2), F.least(max_len, n - F.col("i"))))).alias("l"))
                .withColumn("word", F.substring(F.col("piece"), F.col("i") + 1, F.col("l"))))
    best = (cand.join(words, "word", "left_semi")
                .groupBy("doc_id", "tpos", "ppos", "i").agg(F.max("l").alias("l"))
                .groupBy("doc_id", "tpos", "ppos")
                .agg(F.map_from_entries(F.collect_list(F.struct("i", "l"))).alias("m")))

    # 4: greedy scan over the positions of each run
    r = runs.join(best, ["doc_id", "tpos", "ppos"], "left")
    init = F.struct(F.lit(0).alias("nx"), F.array().cast("array<string>").alias("out"))

    def step(acc, i):
        length = F.coalesce(F.try_element_at(F.col("m"), i), F.lit(1))
        cut = F.struct((i + length).alias("nx"),
                       F.array_append(acc["out"], F.substring(F.col("piece"), i + 1, length)).alias("out"))
        return F.when(i == acc["nx"], cut).otherwise(acc)

    cuts = r.select("doc_id", "tpos", "ppos", F.aggregate(
        F.sequence(F.lit(0), n - 1), init, step, lambda acc: acc["out"]).alias("cuts"))
    han = cuts.select("doc_id", "tpos", "ppos", F.posexplode("cuts").alias("k", "token"))

    # 5: text order per document
    allp = plain.unionByName(han)
    return (allp.groupBy("doc_id")
                .agg(F.array_sort(F.collect_list(F.struct("tpos", "ppos", "k", "token"))).alias("_t"))
                .select("doc_id", F.transform("_t", lambda x: x["token"]).alias("toks")))
