"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks import CATALOG
from checks.compare import connect, differences
from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, con, name):
    entry = CATALOG[name]
    if entry.sql is None:
        assert entry.run(spark, SMALL).count() > 0
    else:
        assert differences(spark, con, entry, SMALL) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys()
