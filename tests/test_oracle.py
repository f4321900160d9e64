"""Every registered query beside its SQL on the smallest tables."""

import pytest
from compare import differences, open_tables

from chunkgate.catalog import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return open_tables(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, db, name):
    assert differences(QUERIES[name](spark, SF).toPandas(), db.execute(SQL[name]).df()) is None


# A hundred rounds are for larger tables: tests/test_boosting.py runs this query with fewer.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"gbt_fit"}))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 3
    assert set(contract.oracle_sql()) <= set(contract.queries())
