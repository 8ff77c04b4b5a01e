"""Steps whose rows must grow no faster than their input."""

from __future__ import annotations

import datetime as dt
import uuid
from collections import Counter

import pytest

from tessera.operators import changes as CH
from tessera.operators import relevance as R
from tessera.operators import terms as T
from tessera.operators.index import SegmentedIndex
from tessera.session import checkpoint_dir


def most_rows(spark, df) -> int:
    """The most rows that any operator of the plan made."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # a plan that stays as it is
    try:
        run = df.select("*")._jdf.queryExecution()
        run.toRdd().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    todo, most = [run.executedPlan()], 0
    while todo:
        node = todo.pop()
        rows = node.metrics().get("numOutputRows")
        most = max(most, rows.get().value() if rows.isDefined() else 0)
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return most


BOND = "securityid string, shortname string, symbol string, institutionid long"
LINE = "user_name string, file_type string, date string, seq long, line string, uid long, reject_reason string"


def keyword_lines(rows):
    return [("u", "keyword", "20240101", seq, line, 1, None) for seq, line in rows]


@pytest.fixture(scope="module")
def no_institutions(spark):
    return spark.createDataFrame([], "institutionid long, shortname string, fullname string")


def test_lines_do_not_meet_every_bond_of_their_symbol(spark, no_institutions):
    # 300 lines and 300 bonds of one symbol made 90,000 rows
    bonds = spark.createDataFrame([(f"S{i}", f"b{i % 3}", "A-1", i) for i in range(300)], BOND)
    lines = spark.createDataFrame(keyword_lines((i, f"ADD,b{i % 4},2,A-1") for i in range(300)), LINE)
    out = CH.keyword_changes(lines, bonds, no_institutions)
    assert Counter(x.securityid for x in out.collect()) == {"S0": 75, "S1": 75, "S101": 75, None: 75}
    assert 300 <= most_rows(spark, out) <= 1000


def test_bond_of_a_line(spark, no_institutions):
    """One bond of the symbol whatever its name, else the first of the name;
    lines of one number count their bonds together."""
    bonds = spark.createDataFrame([("S1", "x", "one", 1), ("S2", "x", "two", 2), ("S3", "y", "two", 3), ("S0", "y", "two", None),
                                   ("S4", None, "none", 4), ("S5", "x", None, 5), (None, "x", "void", 6)], BOND)
    lines = [(1, "ADD,q,2,one"), (2, "ADD,x,2,two"), (3, "ADD,y,2,two"), (4, "ADD,q,2,two"), (5, "ADD,q,2,none"), (6, "ADD,x,2,"),
             (7, "ADD,x,2,void"), (8, "ADD,q,2,one"), (8, "DEL,q,2,one"), (9, "ADD,x,2,one"), (9, "ADD,x,2,two"), (None, "ADD,x,2,one")]
    out = CH.keyword_changes(spark.createDataFrame(keyword_lines(lines), LINE), bonds, no_institutions).collect()
    got = sorted(((x.seq or 0, x.securityid, x.institutionid, x.status) for x in out), key=str)
    no = (None, None, "rejected")
    assert got == sorted([(1, "S1", 1, "accepted"), (2, "S2", 2, "accepted"), (3, "S0", None, "rejected"), (4, *no), (5, "S4", 4, "accepted"), (6, *no),
                          (7, *no), (8, *no), (8, *no), (9, "S1", 1, "accepted"), (9, "S1", 1, "accepted"), (0, *no)], key=str)


def test_a_round_returns_a_row_a_user_and_shard(spark, monkeypatch):
    # It returned a row for every user, shard and document kept
    monkeypatch.setattr(R, "SHARD_DOCS", 16)
    rows, made = [], R._round

    def seen(*args):
        found = made(*args)
        rows.append(found.count())
        return found
    monkeypatch.setattr(R, "_round", seen)
    docs = spark.createDataFrame([(f"N{i}", "rally " * (1 + i % 7) + "bank", 0.0, dt.datetime(2024, 1, 1), 1) for i in range(64)],
                                 "doc_id string, content string, sentiment double, notice_time timestamp, platform int")
    interests = spark.createDataFrame([(u, "k", "rally", 1.0, ["rally"]) for u in range(5)], "uid long, kind string, name string, boost double, toks array<string>")
    out = R.user_relevance(docs.drop("content"), T.doc_terms(docs), interests, limit=20).collect()
    assert len(out) == 100 and all(x.matched_terms == ["rally"] for x in out)
    assert 5 <= sum(rows) <= 5 * 4


def test_index_files_are_sorted_by_the_column_that_differs_first(spark):
    # Sorted by field first, every comparison met equal prefixes
    docs = spark.createDataFrame([(f"D{i}", f"w{i % 5} w{i % 3}", f"w{i % 4}") for i in range(20)], "doc_id string, content string, title string").coalesce(1)
    index = SegmentedIndex(spark, f"{checkpoint_dir(spark)}/sorted-{uuid.uuid4().hex}")
    index.add(docs, {"content": "content", "title": "title"})
    for part, column in (("postings", "term"), ("pieces", "key"), ("rotations", "key")):
        rows = index.table(part).select("_metadata.file_path", "_metadata.row_index", column, "field").orderBy("file_path", "row_index").collect()
        by_file = {}
        for path, _, value, field in rows:
            by_file.setdefault(path, []).append((value, field))
        assert by_file and all(x == sorted(x) for x in by_file.values())


def test_titles_are_not_taken_to_pieces(spark):
    # Every substring of a title that was as long as a listed word became a row
    from tessera.operators import hot as H
    docs = spark.createDataFrame([(i, "ab" * 300 + ("dog" if i else "")) for i in range(4)], "doc_id int, title string")
    words = spark.createDataFrame([("dog", 3.0), ("dog", 4.0), ("bab", None), (None, 9.0)], "word string, score double")
    scored = H.whitelist_score(docs, words)
    assert {x.doc_id: x.white_score for x in scored.collect()} == {0: 2.0, 1: 4.0, 2: 4.0, 3: 4.0}
    flagged = H.blacklisted(docs, words.where("word = 'dog'"))
    assert {x.doc_id: x.black for x in flagged.collect()} == {0: False, 1: True, 2: True, 3: True}
    assert max(most_rows(spark, scored), most_rows(spark, flagged)) <= 8


def test_terms_without_a_weight_are_not_told_apart(spark):
    # All terms of all documents were made distinct before they met the few hot ones
    from tessera.operators import hot as H
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "p int, doc_id string")
    dt = spark.createDataFrame([(1, "a", f"t{i}", 1) for i in range(50)] * 2 + [(1, "b", "t1", 0), (2, "c", "t2", 1)], "p int, doc_id string, term string, tf int")
    weights = spark.createDataFrame([(1, "t1", 1.0), (1, "t2", 2.0), (1, "t2", 2.0), (2, "t1", 5.0), (1, None, 7.0)], "p int, term string, weight double")
    scores = H.doc_scores(dt, weights, docs, ["p"])
    assert {x.doc_id: x.score for x in scores.collect()} == {"a": 5.0, "b": 0.0, "c": 0.0}
    # the deepest join comes before anything is made distinct
    plan = scores._jdf.queryExecution().optimizedPlan().toString().splitlines()
    read = next(i for i, line in enumerate(plan) if "tf#" in line and "Filter" in line)
    above = [line for line in plan[:read] if "Join" in line or "Aggregate" in line]
    assert "Join Inner" in above[-1]


def test_scores_are_not_worked_out_again_inside_joins(spark):
    # a null check of the bin put the score, many times over, into a join's condition
    from pyspark.sql import functions as F
    stats = spark.range(4000).select(F.concat(F.lit("s"), F.col("id") % 3).alias("source"), F.concat(F.lit("t"), F.col("id")).alias("term"), (F.col("id") % 7 + 1).alias("cf"))
    best = T.key_terms(stats, stats.drop("source"), spark.createDataFrame([(50,)], "n_docs long"), 1001, ["source"])
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "LOG1P" in plan and not [x for x in plan.splitlines() if "Join" in x and ("LOG1P" in x or "LOG2" in x)]
    assert Counter(x.source for x in best.collect()) == {"s0": 1001, "s1": 1001, "s2": 1001}


def test_a_batch_writes_few_files_a_day(spark):
    # F16: without AQE in the stream's session every state partition wrote a file a day
    from tessera.sources.store import names_in
    from tessera.streaming import feeds as ST
    root = f"{checkpoint_dir(spark)}/few-{uuid.uuid4().hex}"
    rows = [(i, "u", "text", None, dt.datetime(2024, 1, 1 + i % 3), None) for i in range(300)] * 2
    spark.createDataFrame(rows, ST.FEED_SCHEMAS["micro"]).write.parquet(f"{root}/in")
    ST.ingest(spark, "micro", f"{root}/in", f"{root}/corpus", checkpoint=f"{root}/checkpoint").awaitTermination()
    assert spark.read.parquet(f"{root}/corpus").select("doc_id").distinct().count() == spark.read.parquet(f"{root}/corpus").count() == 300
    for load in (n for n in names_in(spark, f"{root}/corpus") if n.startswith("load=")):
        days = [n for n in names_in(spark, f"{root}/corpus/{load}") if n.startswith("day=")]
        assert len(days) == 3 and all(len([f for f in names_in(spark, f"{root}/corpus/{load}/{d}") if f.endswith(".parquet")]) == 1 for d in days)


def test_tokens_are_sorted_without_a_comparison_function(spark):
    # array_sort calls an interpreted function for every two tokens it compares
    docs = spark.createDataFrame([("a", "b a b"), ("b", ""), ("c", None)], "doc_id string, content string")
    terms = T.doc_terms(docs)
    assert "array_sort" not in terms._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(x) for x in terms.collect()) == [("a", 3, "a", 1), ("a", 3, "b", 2)]


def test_index_is_read_once_for_the_windows_and_the_corpus(spark):
    # document frequencies of the corpus were counted again from the whole index
    from tessera.operators import hot as H
    docs = spark.createDataFrame([(f"d{i}", i % 3, f"w{i % 4} w{i % 4} w{i % 5} x") for i in range(30)], "doc_id string, p int, content string")
    dt, n = T.doc_terms(docs, keep=["p"]), T.doc_count(docs)
    for by in ([], ["p"]):
        own, given = H.hot_term_weights(dt, None, n, by=by), H.hot_term_weights(dt, T.term_stats(dt), n, by=by)
        value = lambda rows: sorted((*x[:-1], round(x[-1], 9)) for x in rows)
        assert value(own.collect()) == value(given.collect()) != []
        reads = [w._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") for w in (own, given)]
        assert reads[0] < reads[1]


def test_tasks_of_relevance_read_no_null_lists(spark, monkeypatch):
    # Spark's Arrow writer goes over all null lists of a batch again for every row of it
    seen, dealt = [], R._dealt

    def each_batch(vectors, users, blocks, *args):
        monkeypatch.setattr(type(vectors), "mapInArrow", lambda rows, *x, map=type(vectors).mapInArrow: seen.append(rows) or map(rows, *x))
        out = dealt(vectors, users, blocks, *args)
        monkeypatch.undo()
        monkeypatch.setattr(R, "_dealt", each_batch)
        return out
    monkeypatch.setattr(R, "_dealt", each_batch)
    docs = spark.createDataFrame([(f"N{i}", "rally " * (1 + i % 7) + "bank", 0.0, dt.datetime(2024, 1, 1), 1) for i in range(8)],
                                 "doc_id string, content string, sentiment double, notice_time timestamp, platform int")
    interests = spark.createDataFrame([(u, "k", "rally", 1.0, ["rally"]) for u in range(3)], "uid long, kind string, name string, boost double, toks array<string>")
    assert R.user_relevance(docs.drop("content"), T.doc_terms(docs), interests, limit=5).count() == 15
    assert len(seen) == 2
    for rows in seen:
        lists = [f.name for f in rows.schema if f.dataType.typeName() == "array"]
        assert len(lists) >= 2 and not any(x[c] is None for x in rows.select(*lists).collect() for c in lists)
