import pytest

import __spark_entry__ as entry
from check_queries import compare, connect
from siltworks.queries import registry

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_a_check():
    assert set(registry.queries()) == set(registry.checks())


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_its_check(spark, con, name):
    assert compare(spark, con, name, SMALL) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_orderkey", "l_linenumber", "price", "shipdate", "flag"] and df.count() > 0
