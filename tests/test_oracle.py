"""Every registered rule query against its DuckDB oracle at sf0.01 (the driver's
correctness gate, run locally): row count, column names, sorted values."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from rowsieve.catalog import REGISTRY
from tools.oracle_check import canon, duck, type_mismatches

QUERIES = {name: E.queries()[name] for name in REGISTRY}
ORACLE = {name: sql for name, sql in E.oracle_sql().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF01)
    cols = sdf.columns
    rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(ORACLE[name])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    drows = rel.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert not type_mismatches(sdf.dtypes, dcols, dtypes)
    assert len(rows) == len(drows)
    assert canon(rows, cols) == canon(drows, dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_id", "event_type", "value", "failed_rules"]
    assert df.count() > 0
