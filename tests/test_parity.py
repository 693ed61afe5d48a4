import pytest

from parity import connect, differences
from plotwright.checks import oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_agrees_with_sql(spark, con, name):
    assert differences(spark, con, SF_DIR, queries()[name], oracle_sql()[name]) is None


@pytest.mark.parametrize("name", [n for n in queries() if n not in oracle_sql()])
def test_gives_rows(spark, name):
    assert queries()[name](spark, SF_DIR).count() > 0
