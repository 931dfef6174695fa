"""Every registered query against DuckDB on the supplied tables."""

import __spark_entry__ as contract
import pytest
from arealis.plans import catalog, oracle
from compare import difference

QUERIES, ORACLE = catalog.all_queries(), oracle.ORACLE
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def test_every_oracle_has_a_query():
    assert not set(ORACLE) - set(QUERIES)
    assert not set(QUERIES) - set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [op for op in FORBIDDEN if op in plan]
    if name in ORACLE:
        assert difference(df, duck, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_contract_names_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert len(df.columns) == 79
    assert df.count() == 651
