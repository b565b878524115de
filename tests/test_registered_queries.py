"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entrypoint
from stratus.workload.catalog import ENTRIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def test_every_query_has_sql():
    assert set(ENTRIES) <= set(entrypoint.queries())
    assert set(ENTRIES) <= set(entrypoint.oracle_sql())


def test_entry(spark):
    assert entrypoint.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query(spark, database, name):
    df = entrypoint.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    cursor = database.execute(entrypoint.oracle_sql()[name])
    described = sorted((d[0], str(d[1])) for d in cursor.description)
    names = [d[0] for d in cursor.description]
    expected = [tuple(plain(r[names.index(c)]) for c, _ in described) for r in cursor.fetchall()]
    assert sorted((c, TYPES.get(t, t)) for c, t in df.dtypes) == described
    got = [tuple(plain(r[c]) for c, _ in described) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
