"""Every registered query against its DuckDB oracle SQL (the driver's check),
on the smallest driver tables; queries without SQL must at least run and keep
a stable schema.  Set TESSERA_TEST_SF to use another scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck
from tessera.plans import registry

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
QUERIES, ORACLE = registry()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason=f"no driver tables at {SF}")


@pytest.fixture(scope="module")
def con():
    c = duck(SF)
    yield c
    c.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        n, problems = compare(df, con, ORACLE[name])
        assert not problems, problems
    else:
        schema = df.schema
        assert df.count() >= 0
        assert QUERIES[name](spark, SF).schema == schema


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name, least", [("key_terms_whole", 1001), ("distinctive_terms_whole", 1001), ("distinctive_terms_tfpdf", 1001)])
def test_term_queries_of_the_reference_size(spark, con, name, least):
    """More terms than SMALL_K a group, so the range-partitioned top-k is what
    the SQL is compared with."""
    n, problems = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert not problems and n >= least


def test_all_feeds_pass_through_the_stream(spark, con):
    df = QUERIES["feed_streams_ingest"](spark, SF)
    assert not compare(df, con, ORACLE["feed_streams_ingest"])[1]
    assert {r.platform for r in df.select("platform").distinct().collect()} == \
        {x for x, in con.execute(f"SELECT DISTINCT platform FROM ({ORACLE['feed_streams_ingest']})").fetchall()}
    assert df.select("platform").distinct().count() == 3
