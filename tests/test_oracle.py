"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from splitsafe.plans.registry import load_all
from tools.oracle_check import compare, duck

from .conftest import SF001

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_audit_query_has_an_oracle():
    audit, sql = load_all()
    missing = sorted(set(audit) - set(sql))
    assert not missing


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    rows = [tuple(r) for r in sdf.collect()]
    res = con.execute(SQL[name])
    dk_cols = [d[0] for d in res.description]
    assert compare(rows, sdf.columns, res.fetchall(), dk_cols) == "ok"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns[:3] == ["check", "name", "risk"]


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_types_match_oracle(spark, con, name):
    sp = {c: SPARK_TO_DUCK.get(t, t) for c, t in QUERIES[name](spark, SF001).dtypes}
    dk = {d[0]: str(d[1]) for d in con.execute(SQL[name]).description}
    assert sp == dk
