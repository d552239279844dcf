"""Every query with SQL gives the same names, types and values as DuckDB on the same tables, by a plan
without Python rows, cross joins or windows in a single task."""

from __future__ import annotations

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import entry_oracle
import entry_queries

QUERIES = entry_queries.queries()
ORACLE = entry_oracle.oracle_sql()
#: Models: tests/test_recommend.py and tests/test_churn.py compare them with what was planted.
MODELS = {"recommend_products", "recommendation_recall", "churn_scores"}
WITHOUT_SQL = {"storage_layout"} | MODELS

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def sort_key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def canonical(rows):
    cleaned = [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows
    ]
    return sorted(cleaned, key=sort_key)


def check_plan(df, name):
    text = df._jdf.queryExecution().executedPlan().toString()
    for word in ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if re.search(r"\bWindow \[", line):
            # category_top3 numbers three rows; every other window has a partition.
            assert "SinglePartition" not in "".join(lines[i + 1 : i + 4]) or name == "category_top3"


@pytest.fixture(scope="module")
def duck(sf001):
    con = duckdb.connect()
    for path in Path(sf001).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_keys_match():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf001, name):
    df = QUERIES[name](spark, sf001)
    relation = duck.sql(ORACLE[name])
    names = sorted(df.columns)
    assert names == sorted(relation.columns)
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == duck_types
    mine = canonical([tuple(r[c] for c in names) for r in df.collect()])
    check_plan(df, name)
    position = [relation.columns.index(c) for c in names]
    theirs = canonical([tuple(r[i] for i in position) for r in relation.fetchall()])
    assert len(mine) == len(theirs)
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_without_sql_has_rows(spark, sf001, name):
    df = QUERIES[name](spark, sf001)
    assert df.collect()
    if name not in MODELS:
        check_plan(df, name)


def test_flagship(spark):
    assert entry.entry(spark).count() == 30
