"""Every registered query against its SQL in DuckDB, on the smallest given tables."""

import datetime
import os
import re
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from workload import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (Decimal, datetime.datetime)):
        return str(value)
    return value


def assert_scalable(df):
    """No cross or nested-loop join, no Python rows, no window over everything."""
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert node not in text
    for window in re.findall(r"^\(\d+\) Window\b.*?\n\n", text, re.M | re.S):
        assert not re.search(r"\], \[\]$", window.strip())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    assert_scalable(df)
    names = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    sql = ORACLE.get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    order = [[d[0] for d in result.description].index(c) for c in names]
    assert len(result.description) == len(names)
    assert got == Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["tenant", "table_name", "n", "checksum"]
