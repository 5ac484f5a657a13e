"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

DATA = "/root/testdata/sf0.001"
# the SQL states the law for samples beyond 10,000 rows, which the smallest tables do not reach
LARGER = {"e6_ks_pvalue": "/root/testdata/sf0.01"}
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not present")


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query(spark, connection, name):
    data = LARGER.get(name, DATA)
    if name in LARGER:
        connection = connect(data)
    df = contract.queries()[name](spark, data)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, connection, sql) is None


def test_entry(spark):
    assert contract.entry(spark).count() > 0
