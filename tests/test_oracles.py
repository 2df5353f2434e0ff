"""Every query with SQL agrees with DuckDB on the smallest tables."""

import pytest

from checks import catalog
from checks.compare import compare, connect
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_runs_and_agrees_with_its_sql(spark, connection, name):
    """Queries without SQL have to run and give rows."""
    said = compare(spark, connection, SMALL, name)
    assert said.startswith("same" if name in catalog.ORACLES else "rows only") and "(0)" not in said


def test_every_oracle_has_a_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_flagship_has_rows(spark):
    import __spark_entry__ as entry_module

    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.queries()) >= set(catalog.QUERIES)
