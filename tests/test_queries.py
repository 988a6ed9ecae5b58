import pytest

import __spark_entry__ as entry
from check_oracle import compare
from tidebook.plans.catalog import QUERIES
from tidebook.plans.oracle import ORACLE

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "ticker" and df.count() == 5


@pytest.mark.parametrize("name", [name for name in QUERIES])
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare(df, SF_DIR, ORACLE[name]) is None
