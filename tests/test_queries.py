"""Every registered core query against its SQL, and those without SQL for running."""

import pytest

from conftest import same_rows
from lexmill.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf_dir, duck, name):
    same_rows(QUERIES[name](spark, sf_dir), duck, SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns
    df.collect()


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
