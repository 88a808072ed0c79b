import pytest
from check_oracles import connect, difference

import __spark_entry__ as entry
from tokenmill.plans import oracles, registered

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry.entry(spark).columns == ["split", "shard_id", "n_tokens", "name"]


def test_every_query_has_a_counterpart():
    assert set(registered.QUERIES) == set(oracles.SQL)


def test_entry_offers_all_queries():
    assert set(registered.QUERIES) <= set(entry.queries())
    assert set(oracles.SQL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    assert difference(got, duck.execute(entry.oracle_sql()[name]).df()) is None
