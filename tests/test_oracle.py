"""Every registered query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tillroll import registry
from tillroll.sources.testdata import TABLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables not present")

ORACLE = registry.oracle()
QUERIES = registry.QUERIES


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return None if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE",
}


def _duck_type(spark_type) -> str:
    t = spark_type.simpleString()
    return t.upper() if t.startswith("decimal") else SPARK_TO_DUCK.get(t, t)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    s_rows = sdf.collect()
    rel = duck.sql(ORACLE[name])
    d_rows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    d_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    assert {f.name: _duck_type(f.dataType) for f in sdf.schema.fields} == d_types
    order = sorted(sdf.columns)
    si = [sdf.columns.index(c) for c in order]
    di = [rel.columns.index(c) for c in order]
    a = sorted((tuple(_norm(r[i]) for i in si) for r in s_rows), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in di) for r in d_rows), key=repr)
    assert a == b


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "segment" in df.columns
