"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import differences, engine

from gridlake.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return engine(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, FOLDER), con, QUERIES[name].sql) is None


@pytest.mark.parametrize("name", ["regions_key", "customer_ranks", "describe_bounded", "series_gaps", "dup_rows", "upsert_partial", "frontier"])
def test_result_does_not_depend_on_partition_count(spark, con, name):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert differences(QUERIES[name](spark, FOLDER), con, QUERIES[name].sql) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["month", "mean", "peak", "low"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
