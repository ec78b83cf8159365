"""Every registered query against its SQL on DuckDB, rows compared as multisets."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from changeflow.workload import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


# Tables where one customer, one order, one item, one event type and copies of one row each hold a third.
SKEWED = {
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey) FROM t
                 UNION ALL SELECT t.* FROM t, range(700) WHERE o_orderkey = 42""",
    "lineitem": """SELECT * REPLACE (
                     CASE WHEN l_partkey % 3 = 0 THEN 42 ELSE l_orderkey END AS l_orderkey,
                     CASE WHEN l_partkey % 3 = 0 AND l_suppkey % 2 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber,
                     CASE WHEN l_partkey % 3 = 0 THEN TIMESTAMP '1998-01-01' ELSE l_shipdate END AS l_shipdate,
                     CASE WHEN l_partkey % 3 = 0 THEN 3 ELSE l_partkey END AS l_partkey,
                     CASE WHEN l_partkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey) FROM t""",
    "events": """SELECT * REPLACE (
                   CASE WHEN event_id % 3 = 0 THEN 6 ELSE user_id END AS user_id,
                   CASE WHEN event_id % 3 = 0 THEN 'view' ELSE event_type END AS event_type,
                   CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-15' ELSE ts END AS ts,
                   CASE WHEN event_id % 3 = 0 THEN 1.25 ELSE value END AS value) FROM t""",
}


@pytest.fixture(scope="module", params=["plain", "skewed"])
def data_dir(request, sf_dir, tmp_path_factory):
    if request.param == "plain":
        return sf_dir
    small, out = "/root/testdata/sf0.001", tmp_path_factory.mktemp("skewed")
    for name in "customer part orders lineitem events".split():
        source = f"(SELECT * FROM '{small}/{name}.parquet')"
        query = SKEWED.get(name, "SELECT * FROM t")
        duckdb.sql(f"COPY (WITH t AS {source} {query}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.fixture(scope="module")
def duck(data_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(data_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in data)


KIND = {"long": "int", "integer": "int", "BIGINT": "int", "INTEGER": "int", "HUGEINT": "HUGEINT",
        "string": "str", "VARCHAR": "str", "double": "float", "DOUBLE": "float",
        "boolean": "bool", "BOOLEAN": "bool"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, data_dir, duck, name):
    df = QUERIES[name](spark, data_dir)
    got = df.collect()
    want = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    spark_kinds = {f.name: KIND[f.dataType.typeName()] for f in df.schema}
    duck_kinds = {c: KIND[str(t)] for c, t in zip(want.columns, want.types)}
    assert spark_kinds == duck_kinds
    mine, theirs = rows(df.columns, got), rows(want.columns, want.fetchall())
    assert sum(mine.values()) > 0
    assert mine == theirs, (list((mine - theirs).items())[:3], list((theirs - mine).items())[:3])


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry_registers_all():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())
