"""Every registered query against its SQL check; those without one must deliver rows."""

import pytest

from fcbias.catalog import ORACLES, QUERIES

from .compare import difference


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, folder, name):
    assert difference(name, spark, folder) is None


def test_no_check_without_query():
    assert ORACLES.keys() <= QUERIES.keys()


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(1).collect()
    assert entry.queries().keys() >= QUERIES.keys()
    assert entry.oracle_sql().keys() >= ORACLES.keys()
