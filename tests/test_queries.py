import pytest

from pacewright.plans import registry
from tests.parity import engine, same

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def con(tables_dir):
    return engine(tables_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(name, spark, tables_dir, con):
    same(QUERIES[name](spark, tables_dir), con, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(name, spark, tables_dir):
    assert QUERIES[name](spark, tables_dir).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
