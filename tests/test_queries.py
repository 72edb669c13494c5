"""Every registered query against its SQL over the smallest tables."""

import pytest
from compare import compare, connect

from shelfmark.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    if name not in registry.SQL:
        assert registry.QUERIES[name](spark, SF).count() > 0
        return
    faults = compare(spark, con, SF, registry.QUERIES[name], registry.SQL[name])
    assert [f for f in faults if f != "no rows"] == []


def test_every_statement_has_a_query():
    assert set(registry.SQL) <= set(registry.QUERIES)
