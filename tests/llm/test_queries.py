"""Registered queries of the subpackage against their SQL on the smallest scale."""

from pathlib import Path

import duckdb
import pytest

from topicmill.llm.oracle import ORACLE
from topicmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


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


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    records = df.collect()
    assert records and ordered(records, df.columns) == ordered(result.fetchall(), columns)


def test_each_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
