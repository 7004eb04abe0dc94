import pytest
from check_oracles import canonical, connect

from __spark_entry__ import entry, oracle_sql, queries
from chronolink.oracles import ORACLES
from chronolink.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_as_sql(spark, con, name):
    df = queries()[name](spark, SF_DIR)
    relation = con.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    want = canonical(relation.fetchall(), relation.columns)
    assert want
    assert canonical(df.collect(), df.columns) == want


def test_entry(spark):
    assert entry(spark).count() > 0
