"""Every query of the library itself against its DuckDB oracle on the smallest tables.

The corpus operators, where the folder is there, have their tests in tests/llm.
"""

import pytest

import __spark_entry__ as entry
from compare import compare, duck_connect

from ledgerlake.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
ALL = entry.queries()
QUERIES = {name: ALL[name] for name in catalog.QUERIES}
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(catalog.ORACLE) and set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLE[name], SF_DIR)
    assert res["ok"], res


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "fact_guid" in df.columns
