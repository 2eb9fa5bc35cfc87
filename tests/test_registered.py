"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from compare import compare, duck

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the given tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


# the optional corpus queries have tests of their own
CORE = [name for checks in entry.CHECKS if ".llm." not in checks.__name__ for name in checks.QUERIES]


def test_every_query_has_its_sql():
    assert set(CORE) <= entry.oracle_sql().keys()


def test_the_flagship_has_ten_rows(spark):
    assert entry.entry(spark).count() == 10


@pytest.mark.parametrize("name", CORE)
def test_rows_equal_the_sql(spark, con, name):
    equal, _, message = compare(spark, con, SMALL, name, entry.queries()[name], entry.oracle_sql()[name])
    assert equal, message


@pytest.mark.parametrize("name", ["postings", "search_classic", "links_allowed", "extract_fields", "log_page_join"])
def test_plans_stay_in_the_jvm_without_pairing_all_rows(spark, name):
    plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_postings_are_counted_without_a_shuffle(spark):
    from pagequarry.operators.index import build_index

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    plan = build_index(docs, fields=["text"]).postings._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
