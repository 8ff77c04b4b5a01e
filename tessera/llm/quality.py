"""Quality rules as weak supervision.

Each rule votes good (1) or bad (-1) on a document or abstains (0).  How often
each combination of votes occurs (at most 3^rules rows) is all that the label
model needs: expectation-maximisation over that table estimates how often each
rule's votes are right, from "what no rule calls bad is good".  A document's
posterior probability of being good replaces "passes every rule": a fault
found by a weak rule can be outvoted, votes of accurate rules cannot.

Documents are read once: metrics and votes are written to the shared folder
and every iteration aggregates the table of vote combinations.  Only two sums a
rule come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import packed, text_or_empty, words, written

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
KEEP_FROM = 0.5  # posterior quality
ITERATIONS = 20
SETTLED = 1e-3
START_SURE = 0.9  # posterior of a document that no rule calls bad, at the start
PRIOR_RIGHT, PRIOR_WRONG = 8.0, 2.0  # pseudo-votes on every rule's accuracy


def _share(part: str, whole: str) -> Column:
    """part / whole, 0 for nothing of nothing."""
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def rules() -> dict[str, Column]:
    """The rules' votes over the metric columns."""
    length = _share("word_chars", "n_words")
    symbols, repeats = _share("n_symbols", "n_words"), _share("n_repeat_words", "n_words")
    copies, upper = _share("n_dup_lines", "n_lines"), _share("n_upper", "word_chars")
    ends, distinct = _share("n_ends", "n_words"), _share("n_distinct", "n_words")
    plain = (symbols < 0.1) & (upper < 0.2) & (length >= 3) & (length <= 10)
    bad = lambda c: F.when(c, -1).otherwise(0).cast("byte")
    good = lambda c: F.when(c, 1).otherwise(0).cast("byte")
    return {
        "short": bad(F.col("n_words") < MIN_WORDS),
        "word_length": bad((length < 2) | (length > 15)),
        "symbols": bad(symbols > 0.2),
        "copied_lines": bad(copies > 0.5),
        "repeats": bad(repeats > 0.5),
        "capitals": bad(upper > 0.5),
        "no_sentences": bad((ends == 0) | (ends > 0.5)),
        "prose": good(plain & (ends > 0.01) & (ends < 0.3)),
        "varied": good(plain & (F.col("n_words") >= 80) & (distinct > 0.3) & (copies < 0.1)),
    }


def with_repeat_words(table: DataFrame, words_col: str, out: str) -> DataFrame:
    """Adds the number of words inside a window of three words that occurs at
    least twice in the document, the first occurrence included.

    Windows are compared by 64-bit hash.  Where no hash repeats (most texts)
    that is all; else (hash, place) pairs are sorted, so that the cost stays
    n log n however long the text.  Each step is a projection of its own: a
    lambda that looks at its neighbours then reads a finished array."""
    keep, w = table.columns, F.col(words_col)
    hashes = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                    lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    step = table.select(*keep, hashes.alias("_hashes"))

    h = F.col("_hashes")
    pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    step = step.select(*keep, F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(pairs).alias("_pairs"))

    def twin(e: Column, k: Column) -> Column:
        return F.coalesce(e["h"] == F.get(F.col("_pairs"), k)["h"], F.lit(False))

    again = F.filter("_pairs", lambda e, k: twin(e, k - 1) | twin(e, k + 1))
    step = step.select(*keep, F.array_sort(F.transform(again, lambda e: e["i"])).alias("_starts"))
    covered = F.transform("_starts", lambda s, k: F.least(F.lit(3), F.coalesce(F.get(F.col("_starts"), k + 1) - s, F.lit(3))))
    return step.select(*keep, F.aggregate(covered, F.lit(0), lambda a, x: a + x).cast("long").alias(out))


def with_metrics(table: DataFrame, text: Column) -> DataFrame:
    """Adds the metric columns; `text` must not be null."""
    t = table.columns
    split = table.select(*t, text.alias("_text"), words(text).alias("_words"))
    lines = F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    big = lambda c: c.cast("long")
    split = with_repeat_words(split.select(*split.columns, lines.alias("_lines")), "_words", "n_repeat_words")
    return split.select(
        *t,
        big(F.size("_words")).alias("n_words"),
        big(F.char_length(F.array_join("_words", ""))).alias("word_chars"),
        big(F.regexp_count("_text", F.lit(SYMBOLS))).alias("n_symbols"),
        big(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        "n_repeat_words",
        big(F.size("_lines")).alias("n_lines"),
        big(F.regexp_count("_text", F.lit(r"\p{Lu}"))).alias("n_upper"),
        big(F.regexp_count("_text", F.lit(r"[.!?](?=[\x20\x09-\x0D]|$)"))).alias("n_ends"),
        big(F.size(F.array_distinct("_words"))).alias("n_distinct"),
    )


def posterior(votes: list[Column], right: list[float]) -> Column:
    """Probability of a good document when good and bad are as likely and
    rule k's votes are right with probability `right[k]`; 0.5 without votes."""
    odds = F.lit(0.0)
    for v, r in zip(votes, right):
        odds = odds + v * math.log(r / (1 - r))
    return 1 / (1 + F.exp(-odds))


def _estimated(patterns: DataFrame, names: list[str], p: Column) -> list[float]:
    """Each rule's accuracy when documents are good with probability `p`."""
    given = patterns.select("n", p.alias("p"), F.explode(F.array(*[
        F.struct(F.lit(k).alias("rule"), F.col(c).alias("vote")) for k, c in enumerate(names)])).alias("v"))
    agrees = F.when(F.col("v.vote") == 1, F.col("p")).otherwise(1 - F.col("p"))
    sums = given.where("v.vote != 0").groupBy("v.rule").agg(F.sum(F.col("n") * agrees), F.sum("n"))
    found = {rule: (agreed, n) for rule, agreed, n in sums.collect()}  # a row a rule
    at = lambda k: found.get(k, (0.0, 0))
    return [(at(k)[0] + PRIOR_RIGHT) / (at(k)[1] + PRIOR_RIGHT + PRIOR_WRONG) for k in range(len(names))]


def fit(votes: DataFrame, names: list[str]) -> list[float]:
    """The rules' accuracies by EM on the counts of vote combinations, until
    they settle, `ITERATIONS` at most.  Without rows they are the prior's."""
    patterns = written(votes.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "votes")
    any_bad = F.least(*[F.col(c) for c in names]) < 0
    right = _estimated(patterns, names, F.when(any_bad, 1 - START_SURE).otherwise(START_SURE))
    for _ in range(ITERATIONS):
        last, right = right, _estimated(patterns, names, posterior([F.col(c) for c in names], right))
        if max(abs(a - b) for a, b in zip(last, right)) < SETTLED:
            break
    return right


def _judged(table: DataFrame, text: Column, keep: list[str]) -> DataFrame:
    """The columns `keep` of `table` with metrics and verdict."""
    voted = with_metrics(table, text)
    names = list(rules())
    voted = voted.select(*keep, *voted.columns[len(table.columns):])
    voted = written(voted.select("*", *[c.alias(f"vote_{k}") for k, c in rules().items()]), "quality")
    names = [f"vote_{k}" for k in names]
    quality = posterior([F.col(c) for c in names], fit(voted, names))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return voted.select(*keep, *BASE, failed.alias("base_failed"),
                        (~failed & (quality >= KEEP_FROM)).alias("kept"), quality.alias("quality"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, quality (posterior, 0 to 1).

    A null or empty text has no words and fails the base rules.  Rows that
    repeat are judged alike, an empty table gives no rows; other columns are
    not read."""
    return _judged(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text_in")),
                   text_or_empty("text_in"), ["doc_id"])


def drop_low_quality(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that `quality_rules` keeps, with all their columns."""
    table = _judged(packed(docs), text_or_empty(F.col("row")[text_col]), ["row"])
    return table.where("kept").select("row.*")
