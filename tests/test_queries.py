"""Every registered query against its SQL counterpart."""

from pathlib import Path

import pytest
from oracle import connect, differences

import __spark_entry__ as entry_points

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert differences(df, duck, sql) is None


def test_flagship_query(spark):
    rows = entry_points.entry(spark).collect()
    assert sum(r.observations for r in rows) == 1500
