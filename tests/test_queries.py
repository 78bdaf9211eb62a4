"""Every query against its SQL counterpart on the smallest tables."""

import pytest
from oracle_check import connect, differences

from touchline.oracles import ORACLES
from touchline.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_equals_sql(spark, connection, key):
    assert differences(QUERIES[key](spark, FOLDER), connection, ORACLES[key]) == []


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
