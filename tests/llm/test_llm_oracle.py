"""The training-data queries that SQL can express, against DuckDB."""

import __spark_entry__ as entry
import pytest
from conftest import SF001

from rowsieve.llm.catalog import ORACLE_SQL, QUERIES
from tools.oracle_check import canon, duck, type_mismatches


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    found = QUERIES[name](spark, SF001)
    want = duck(SF001).sql(entry.oracle_sql()[name])
    assert not type_mismatches(found.dtypes, want.columns, [str(t) for t in want.types])
    assert canon([tuple(r) for r in found.collect()], found.columns) == canon(want.fetchall(), want.columns)


def test_all_are_registered():
    assert QUERIES.keys() <= entry.queries().keys() and "pipeline" in entry.queries()
