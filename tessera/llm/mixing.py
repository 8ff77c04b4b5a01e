"""Mixing documents to target weights, with soft domain membership.

1. A classifier fitted on the labels table gives every document its posterior
   over domains: naive Bayes scores on hashed words, fitted on at most `SAMPLE`
   labelled documents a domain (taken by hash of the id), then sharpness and
   priors calibrated on all labelled documents.
2. Each document gets a nonnegative rate, by projected-gradient least squares:
   the residuals are expected token totals of the domains (rate x tokens x
   posterior, summed) less their targets, each over the root of the domain's sum
   of squares.  Rates start at 1; a step moves each against the gradient and cuts
   it at the bounds.  Its length is a Barzilai-Borwein one, long and short by
   turns, or the inverse of the gradient's Lipschitz constant when the squares
   are above those of the last `MEMORY` steps.  A step is one aggregate with a
   sum a domain.  Steps go on until all totals are within `MET` of the targets
   or, where the bounds do not allow them, a step moves no more than `SETTLED`.
   Rates are a column, never collected.
3. A rate is carried out as whole copies plus one more with the probability of
   its fraction, decided by a hash of the row.

Native: words, scores, gradients and sums are DataFrame expressions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import packed, rows_with, text_or_empty, words, written

DOMAINS = ["clean", "low", "toxic"]
#: Share of each domain's own expected tokens that the mix should hold.
WEIGHTS = {"clean": 1.0, "low": 0.5, "toxic": 0.2}
BUCKETS = 8192  # hashed words
SAMPLE = 1024  # labelled documents a domain
SMOOTHING = 0.5
SURE = 3.0  # standard errors
SHARPNESS = [0.125, 0.25, 0.5, 1.0, 2.0]
MET = 1e-4  # |total - target| as a share of the target
SETTLED = 5e-5  # root of the mean square by which a step moves the rates, by tokens, with an upper bound
SETTLED_FREE = 1e-6  # without one, where targets are seldom out of reach
MEMORY = 8
STEPS_KEPT = 16  # steps between two written states of the rates


def domain_of_labels() -> Column:
    """Toxic before low quality; rows with neither label known are left out."""
    return (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean"))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def fit(rows: DataFrame, labels: DataFrame, id_col: str) -> list[tuple[float, list[float]]]:
    """Naive Bayes on whether a document holds a hashed word.  Per domain: its
    score without any, and what each adds; words that do not tell the domain
    from the others by `SURE` standard errors count for nothing.  Without
    labelled rows none does."""
    named = labels.select(F.col(id_col).alias("id"), domain_of_labels().alias("domain")).where("domain is not null AND id is not null")
    hashed = named.withColumn("rank", F.xxhash64("id", F.lit("sample"))).withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(SAMPLE)))
    first = hashed.groupBy("domain", "slot").agg(F.min("rank").alias("rank"))
    chosen = hashed.join(first, ["domain", "slot", "rank"]).groupBy("id").agg(F.min("domain").alias("domain"))
    # at most SAMPLE ids a domain
    texts = written(rows.join(F.broadcast(chosen), "id").select("domain", _buckets(F.col("text")).alias("buckets")), "sample")
    sizes = dict(texts.groupBy("domain").count().collect())
    found = texts.select("domain", F.explode("buckets").alias("bucket")).groupBy("domain", "bucket").count().collect()  # domains x BUCKETS
    held = {d: [0] * BUCKETS for d in DOMAINS}
    for d, bucket, n in found:
        held[d][bucket] = n
    out = []
    for d in DOMAINS:
        n, rest = sizes.get(d, 0), sum(x for k, x in sizes.items() if k != d)
        bias, weights = 0.0, [0.0] * BUCKETS
        for k in range(BUCKETS if n and rest else 0):
            a, b = held[d][k], sum(held[x][k] for x in DOMAINS if x != d)
            p, q, both = (a + SMOOTHING) / (n + 1), (b + SMOOTHING) / (rest + 1), (a + b + 2 * SMOOTHING) / (n + rest + 2)
            if abs(p - q) > SURE * math.sqrt(both * (1 - both) * (1 / n + 1 / rest)):
                weights[k] = math.log(p / (1 - p)) - math.log(q / (1 - q))
                bias += math.log((1 - p) / (1 - q))
        out.append((bias, weights))
    return out


def _buckets(text: Column) -> Column:
    return F.array_distinct(F.transform(words(F.lower(text)), _bucket))


def _summed(weights: list[float]) -> Column:
    """Sum of the weights of a text's buckets."""
    values = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one literal
    return F.aggregate("_buckets", F.lit(0.0), lambda a, b: a + F.get(values, b))


def with_scores(table: DataFrame, text: Column, weights: list[tuple[float, list[float]]]) -> DataFrame:
    """Adds n_tokens (words) and a score s_<domain>: the log-odds of the
    hashed words in the text."""
    keep = table.columns
    step = table.select(*keep, words(F.lower(text)).alias("_words"))
    step = step.select(*keep, F.size("_words").cast("long").alias("n_tokens"), F.array_distinct(F.transform("_words", _bucket)).alias("_buckets"))
    return step.select(*keep, "n_tokens", *[(_summed(w) + bias).alias(f"s_{d}") for d, (bias, w) in zip(DOMAINS, weights)])


def _posteriors(sharpness: float, priors: list[float]) -> list[Column]:
    logits = [F.col(f"s_{d}") * sharpness + math.log(p) for d, p in zip(DOMAINS, priors)]
    top = F.greatest(*logits)
    odds = [F.exp(x - top) for x in logits]
    return [o / sum(odds[1:], odds[0]) for o in odds]


def calibrated(scored: DataFrame, id_: Column, labels: DataFrame, id_col: str) -> tuple[float, list[float]]:
    """(sharpness, domain priors): the priors of the labelled documents among
    `scored`, and the sharpness of `SHARPNESS` with the least log loss on them."""
    named = labels.select(F.col(id_col).alias("id"), domain_of_labels().alias("domain")).where("domain is not null")
    known = written(scored.select(id_.alias("id"), *[f"s_{d}" for d in DOMAINS]).join(named, "id"), "labelled")
    n = list(known.agg(*[F.count(F.when(F.col("domain") == d, 1)) for d in DOMAINS]).first())
    priors = [(x + 1) / (sum(n) + len(DOMAINS)) for x in n]
    losses = []
    for t in SHARPNESS:
        right = F.lit(0.0)
        for d, p in zip(DOMAINS, _posteriors(t, priors)):
            right = F.when(F.col("domain") == d, p).otherwise(right)
        losses.append(F.sum(-F.log(F.greatest(right, F.lit(1e-12)))))
    loss = known.agg(*losses).first()
    return (min(zip(loss, SHARPNESS))[1] if sum(n) else 1.0), priors


def _totals(table: DataFrame, rate: Column) -> list[float]:
    row = table.agg(*[F.coalesce(F.sum(rate * F.col("n_tokens") * F.col(f"p_{d}")), F.lit(0.0)) for d in DOMAINS]).first()
    return list(row)


def with_rates(table: DataFrame, targets: dict[str, float] | None = None, weights: dict[str, float] | None = None,
               max_rate: float | None = None) -> DataFrame:
    """Adds the column rate to a narrow written table with n_tokens and
    p_<domain>.

    `targets` are expected token totals by domain; without them they are
    `weights` times the domain's expected tokens in the table.  `max_rate`
    bounds rates from above; targets beyond the bound are met as far as least
    squares allows.  Of the rates that do so, the ones reached from 1."""
    now = _totals(table, F.lit(1.0))
    want = [targets[d] if targets else (weights or WEIGHTS)[d] * x for d, x in zip(DOMAINS, now)]
    total = sum(now)
    if total <= 0:
        return table.withColumn("rate", F.lit(1.0))
    # a domain without tokens reaches no total but 0
    want = np.array([w / total if x > 0 else 0.0 for w, x in zip(want, now)])
    near = MET * np.array([w or x / total for w, x in zip(want, now)])
    p, w, n = [F.col(f"p_{d}") for d in DOMAINS], F.col("n_tokens") / total, len(DOMAINS)
    gram = np.array(table.agg(*[F.sum(w * a * b) for a in p for b in p]).first()).reshape(n, n)
    scale = np.maximum(np.diag(gram), 1e-12)
    size = 1 / np.linalg.eigvalsh(gram / np.sqrt(np.outer(scale, scale))).max()

    def stepped(steps) -> Column:
        """rate and last (the rate before) after the steps: each the pulls of
        the domains."""
        def one(state, pull):
            rate = F.greatest(F.lit(0.0), state["rate"] - sum((pull[i] * x for i, x in enumerate(p)), F.lit(0.0)))
            rate = rate if max_rate is None else F.least(F.lit(float(max_rate)), rate)
            return F.struct(rate.alias("rate"), state["rate"].alias("last"))

        pulls = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])
        return F.aggregate(pulls, F.struct("rate", F.col("rate").alias("last")), one)

    rated = table.withColumn("rate", F.lit(1.0))
    settled = SETTLED_FREE if max_rate is None else SETTLED
    totals, length, steps, squares = np.array(now) / total, size, [], []
    while (np.abs(totals - want) > near).any():
        squares.append(((totals - want) ** 2 / scale).sum())
        steps.append(length * (totals - want) / scale)
        at = rated.select(w.alias("w"), *p, stepped(steps).alias("s")).select("*", "s.rate", "s.last")
        row = at.agg(F.sum(F.col("w") * F.pow(F.col("rate") - F.col("last"), 2)), *[F.sum(F.col("w") * F.col("rate") * x) for x in p]).first()
        moved, last, totals = row[0], totals, np.array(row[1:])
        if moved <= settled**2:
            break
        pull = (totals - last) / scale  # the change of the gradient, by domain
        length = size
        if ((totals - want) ** 2 / scale).sum() <= max(squares[-MEMORY:]) and pull.any():
            across = (totals - last) @ pull
            length = moved / across if len(squares) % 2 else across / (pull @ gram @ pull)
        if len(steps) == STEPS_KEPT:
            rated = written(rated.withColumn("s", stepped(steps)).select(*table.columns, "s.rate"), "rates")
            steps = []
    if steps:
        rated = rated.withColumn("s", stepped(steps)).select(*table.columns, "s.rate")
    return written(rated.select(*table.columns, "rate"), "rates")


def _copies(key: Column, row: Column) -> Column:
    """Whole copies of a rate: its floor, and one more with the probability of
    the fraction; drawn by the id, and for rows without one by `row`."""
    u = F.pmod(F.xxhash64(key, row, F.lit("copies")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor("rate") + F.when(u < F.col("rate") - F.floor("rate"), 1).otherwise(0)).cast("int")


def _measured(scored: DataFrame, id_: Column, labels: DataFrame, id_col: str) -> DataFrame:
    posteriors = _posteriors(*calibrated(scored, id_, labels, id_col))
    scores = {f"s_{d}" for d in DOMAINS}
    return scored.select(*[c for c in scored.columns if c not in scores], *[p.alias(f"p_{d}") for d, p in zip(DOMAINS, posteriors)])


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Per row: doc_id, n_tokens, p_<domain>, rate (nonnegative), copies.

    Posteriors add up to 1; a null or empty text has no tokens, the priors for
    posteriors and no weight in any total.  `labels` (id, quality, toxic) may
    miss rows and hold nulls.  Rows that repeat get the same rate; an empty
    table gives no rows.  Only id and text are read."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    fitted = fit(rows.withColumnRenamed("doc_id", "id"), labels, id_col)
    scored = written(with_scores(rows, F.col("text"), fitted).drop("text"), "scores")
    table = with_rates(written(_measured(scored, F.col("doc_id"), labels, id_col), "posteriors"), **how)
    # a null id says nothing of the row: its draw is by the row's place in the written table
    row = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return table.select("doc_id", "n_tokens", *[f"p_{d}" for d in DOMAINS], "rate", _copies(F.col("doc_id"), row).alias("copies"))


def mixed(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of `docs`, each as often as its rate says (once at most unless
    `max_rate` is given), with all columns."""
    how = {"max_rate": 1.0} | how
    fitted = fit(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), labels, id_col)
    scored = with_scores(packed(docs, rid=F.monotonically_increasing_id()), text_or_empty(F.col("row")[text_col]), fitted)
    scored = written(scored, "scores")
    narrow = scored.select("rid", F.col("row")[id_col].alias("id"), "n_tokens", *[f"s_{d}" for d in DOMAINS])
    rated = with_rates(written(_measured(narrow, F.col("id"), labels, id_col), "posteriors"), **how)
    copies = written(rated.select("rid", _copies(F.col("id"), F.when(F.col("id").isNull(), F.col("rid"))).alias("copies")).where("copies != 1"), "copies")
    rows = scored.select("row", "rid")
    once = rows_with(rows, "rid", copies.select("rid"), copies.count(), "left_anti")
    more = rows.join(copies.where("copies > 1"), "rid").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    out = once.select("row")
    if how["max_rate"] is None or how["max_rate"] > 1:
        out = out.unionByName(more.select("row"))
    return out.select("row.*")
