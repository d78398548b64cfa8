import os

import pytest

from millrace.plans import registry
from tests.compare import DATA, assert_same, connect

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_same_as_sql(spark, con, name):
    assert_same(spark, con, registry.QUERIES[name], registry.ORACLE[name])


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE)


def test_entry_is_ranked(spark):
    import __spark_entry__

    rows = __spark_entry__.entry(spark).orderBy("rank").limit(3).collect()
    assert [r["rank"] for r in rows] == [1, 2, 3]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
