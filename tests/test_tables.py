"""Tables in key buckets, the history log, the large top-k and the sliding
TF-PDF against brute force."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import hot as H
from tessera.operators import report as R
from tessera.operators import terms as T
from tessera.session import checkpoint_dir
from tessera.sources.snapshot import BucketedTable


def root(spark, name):
    return f"{checkpoint_dir(spark)}/test-{name}-{random.random()}"


def put(old, new):
    """Upsert by key: the new value wins."""
    return old.join(new, "k", "left_anti").unionByName(new)


def test_a_batch_rewrites_the_buckets_it_touches(spark):
    # checks W6 J18 J19
    t = BucketedTable(spark, root(spark, "buckets"), ["k"], n_buckets=8)
    t.create(spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    before = t.manifest.load()[1]["cells"]
    new = spark.createDataFrame([(3, "b"), (1000, "b"), (None, "n")], "k long, v string")
    done = t.merge(new, put, "one")
    after = t.manifest.load()[1]["cells"]
    assert 1 <= done["touched"] <= 3 and sum(before.get(c) != p for c, p in after.items()) == done["touched"]
    rows = {r.k: r.v for r in t.read().collect()}
    assert len(rows) == 102 and rows[3] == "b" and rows[1000] == "b" and rows[None] == "n" and rows[4] == "a"
    assert t.merge(new, lambda old, new: old.limit(0), "one")["touched"] == 0  # delivered again
    assert t.read().count() == 102
    assert t.merge(new.limit(0), put, "nothing")["touched"] == 0
    t.merge(new.where("k = 3"), lambda old, new: old.limit(0), "empties")  # a bucket may lose all its rows
    assert 3 not in {r.k for r in t.read().collect()}


def test_a_failed_batch_leaves_the_table(spark):
    t = BucketedTable(spark, root(spark, "failed"), ["k"], n_buckets=4)
    t.create(spark.range(10).select(F.col("id").alias("k"), F.lit("a").alias("v")))
    bad = spark.createDataFrame([(1, "x")], "k long, v string")
    with pytest.raises(Exception):
        t.merge(bad, lambda old, new: old.select("k", F.raise_error(F.lit("stop")).cast("string").alias("v")), "bad")
    assert {r.v for r in t.read().collect()} == {"a"} and t.read().count() == 10


def test_other_dates_are_not_read(spark):
    t = BucketedTable(spark, root(spark, "dates"), ["k"], n_buckets=2, partition="d")
    t.create(spark.createDataFrame([(1, "2024-01-01", "a"), (1, "2024-01-08", "a"), (2, None, "a")], "k long, d string, v string"))
    seen = []

    def put_dated(old, new):
        seen.append({r.d for r in old.collect()})
        return old.join(new, ["k", "d"], "left_anti").unionByName(new)
    t.merge(spark.createDataFrame([(1, "2024-01-08", "b")], "k long, d string, v string"), put_dated, "x")
    assert seen == [{"2024-01-08"}]
    assert sorted((r.d or "", r.v) for r in t.read().collect()) == [("", "a"), ("2024-01-01", "a"), ("2024-01-08", "b")]


def test_weekly_merge_keeps_what_null_does_not_replace(spark):
    # checks J19 A18
    cols = ", ".join(f"{c} {'bigint' if c.startswith('news_count') or c == 'neg_news_id' else 'int' if c == 'neg_top_flag' else 'string'}" for c in R.WEEKLY_COLUMNS)
    def row(i, **v):
        return (i, dt.date(2024, 1, 29), *[v.get(c) for c in R.WEEKLY_COLUMNS])
    schema = f"institutionid long, report_date date, {cols}"
    old = spark.createDataFrame([row(1, location="a", news_count=3), row(2, shortname="s")], schema)
    new = spark.createDataFrame([row(1, location="b", fullname="f"), row(3, location="c")], schema)
    got = {r.institutionid: r for r in R.weekly_merge(old, new).collect()}
    assert (got[1].location, got[1].news_count, got[1].fullname) == ("b", 3, "f") and got[2].shortname == "s" and got[3].location == "c"
    counts = {r["column"]: (r.existing, r.replaced, r.filled, r.same) for r in R.conflict_counts(old, new).collect()}
    assert counts["location"] == (1, 1, 0, 0) and counts["fullname"] == (1, 0, 1, 0) and counts["news_count"] == (1, 0, 0, 0)


def test_history_log(spark):
    # checks S13 W8 J23
    log = H.HistoryLog(spark, root(spark, "log"))
    assert log.newest() is None and log.read().count() == 0
    p = [dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 17, 30), dt.datetime(2024, 1, 2, 9)]
    rows = lambda *x: spark.createDataFrame(list(x), "period_end timestamp, term string, weight double")
    log.append(rows((p[0], "a", 1.0), (p[1], "b", 2.0)))
    log.append(rows((p[1], "b", 9.0), (p[2], "c", 3.0)))  # only the newer period is taken
    assert log.newest() == "202401020900"
    assert sorted((r.term, r.weight) for r in log.read().collect()) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]
    log.append(rows((p[1], "z", 5.0)), again=True)  # a later load of a period replaces it
    assert sorted((r.term, r.weight) for r in log.read().collect()) == [("a", 1.0), ("c", 3.0), ("z", 5.0)]
    assert [r.term for r in log.read(newest=1).collect()] == ["c"]


@pytest.mark.parametrize("by", [(), ("g",)])
def test_large_top_k_equals_a_sort(spark, monkeypatch, by):
    # checks T3: ties, null scores and groups, fewer rows than k
    monkeypatch.setattr(T, "SMALL_K", 1)
    r = random.Random(3)
    rows = [(r.choice(["x", "y", None]), f"{r.choice('abc')}{i:04d}", r.choice([None, 0.0, -2.5, 1.0, 1.0, r.random() * 1e6])) for i in range(2000)]
    rows += [("small", f"t{i}", 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, term string, score double")
    for k in (7, 300, 5000):
        got = sorted((x.g or "", x.term) for x in T.top_terms(df, k, by=by).collect())
        expected = []
        for g in ({x[0] for x in rows} if by else {0}):
            mine = [x for x in rows if not by or x[0] == g]
            mine.sort(key=lambda x: (x[2] is not None, x[2] or 0.0, x[1]), reverse=True)
            expected += [(x[0] or "", x[1]) for x in mine[:k]]
        assert got == sorted(expected)


def test_large_top_k_has_no_global_sort(spark, monkeypatch):
    monkeypatch.setattr(T, "SMALL_K", 1)
    df = spark.range(1000).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("term"), F.rand(1).alias("score"))
    plan = T.top_terms(df, 10)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def test_sliding_tfpdf_equals_every_window(spark):
    # checks A5
    r = random.Random(1)
    docs = [(i, dt.date(2024, 1, 1) + dt.timedelta(days=r.choice([0, 1, 2, 5, 6, 14])), r.choice("pq")) for i in range(40)]
    terms = [(i, t, r.randint(1, 3)) for i, *_ in docs for t in "abc" if r.random() < 0.5]
    by = {i: (d, c) for i, d, c in docs}
    days = spark.createDataFrame(docs, "doc_id long, day date, channel string")
    dt_ = spark.createDataFrame([(i, *by[i], t, n) for i, t, n in terms], "doc_id long, day date, channel string, term string, tf long")
    got = {(x.day, x.term): x.weight for x in H.tfpdf_daily(dt_, days, days=4).collect()}
    expected = {}
    last = max(d for _, d, _ in docs)
    day = min(d for _, d, _ in docs)
    while day <= last:
        inside = {i for i, d, _ in docs if day - dt.timedelta(days=3) <= d <= day}
        sizes = {c: sum(1 for i in inside if by[i][1] == c) for c in "pq"}
        for t in "abc":
            f = {c: [n for i, u, n in terms if u == t and i in inside and by[i][1] == c] for c in "pq"}
            if any(f.values()):
                norm = math.sqrt(sum(sum(x) ** 2 for x in f.values()))
                expected[(day, t)] = sum(sum(x) / norm * math.exp(len(x) / sizes[c]) for c, x in f.items() if x)
        day += dt.timedelta(days=1)
    assert got.keys() == expected.keys() and all(abs(got[k] - v) < 1e-9 for k, v in expected.items())
