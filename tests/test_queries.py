import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.comparing import differences

FOLDER = "/root/testdata/sf0.001"


def test_entry(spark):
    assert not entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    df = queries()[name](spark, FOLDER)
    if name in oracle_sql():
        assert differences(df, oracle_sql()[name], FOLDER) == []
    else:
        assert not df.isEmpty()
