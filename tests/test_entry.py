import datetime as dt
import warnings

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from flowtally_checks import feeds
from flowtally_checks.compare import connect, differences
from flowtally_checks.oracles import ORACLES
from flowtally_checks.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(DATA)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert differences(
            entry_points.queries()[name](spark, DATA), duck, entry_points.oracle_sql()[name]) is None


def test_messages_are_dealt_over_tasks(spark):
    """A table of one file is decoded by several tasks, whole."""
    rows = feeds.events(spark, "/root/testdata/sf0.1")
    tasks = feeds.hls_messages(rows).groupBy(F.spark_partition_id().alias("task")).count().collect()
    total = spark.read.parquet("/root/testdata/sf0.1/events.parquet").count()
    assert sum(r["count"] for r in tasks) == total
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < 0.6 * total


@pytest.mark.parametrize("name", ["hls_wide_values", "rtmp_wide_values"])
def test_totals_beyond_bigints_are_whole(spark, folder, name):
    """Many terabyte counts of one day and application: the exact total, where no bigint holds it."""
    path = folder("wide")
    rows = [(i, dt.datetime(2024, 1, 15, 1), i % 3, 100.0) for i in range(9_000_000, 9_000_400)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, value double").write.parquet(
        f"{path}/events.parquet")
    found = entry_points.queries()[name](spark, path)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{path}/events.parquet/*.parquet'")
    sql = entry_points.oracle_sql()[name].replace("cast(sum(flux) as bigint) as flux", "sum(flux) as flux")
    expected = {app: int(flux) for app, flux in con.execute(f"select app, flux from ({sql})").fetchall()}
    assert max(expected.values()) > 2**63
    assert {r["app"]: int(r["flux"]) for r in found.collect()} == expected
    assert [c for c, kind in found.dtypes if kind.startswith("decimal")] == ["flux"]
