"""Every registered query against its SQL on the smallest scale."""

import importlib
import re
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from topicmill.plans.oracle import ORACLE
from topicmill.plans.queries import QUERIES as CORE

SF = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in contract.queries().items() if name in CORE}


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    db.execute("set timezone = 'UTC'")
    for path in sorted(Path(SF).glob("*.parquet")):
        db.execute(f"create view {path.stem} as select * from '{path}'")
    return db


def ordered(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in records)


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES) == set(CORE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    records = df.collect()
    assert records and ordered(records, df.columns) == ordered(result.fetchall(), columns)


@pytest.mark.parametrize("name", ["positive_counts", "vocab_term", "dedup_content", "label_topic_by_row"])
def test_no_cross_product(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert {r.split for r in contract.entry(spark).collect()} <= {"train", "valid", "test"}


def test_entry_without_the_subpackages_libraries(monkeypatch):
    """A missing library takes the training-data queries away, not the others."""
    monkeypatch.setitem(sys.modules, "topicmill.llm.queries", None)
    try:
        importlib.reload(contract)
        assert set(contract.queries()) == set(CORE) == set(contract.oracle_sql())
    finally:
        monkeypatch.undo()
        importlib.reload(contract)


def test_scans_are_pruned(spark):
    plan = QUERIES["clean_hashtag"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    reads = [set(re.findall(r"(\w+):", r)) for r in re.findall(r"ReadSchema: struct<([^>]*)>", plan)]
    # The texts and what filters them; of the events at most the id, to know there is one.
    assert {"doc_id", "text", "lang"} in reads
    assert all(r <= {"doc_id", "text", "lang"} or r <= {"event_id"} for r in reads)
    assert "EqualTo(lang,en)" in plan
