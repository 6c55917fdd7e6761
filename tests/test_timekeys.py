from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from flowtally.functions import timekeys

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


@pytest.mark.parametrize("zone", ["Asia/Shanghai", "UTC", "Asia/Kathmandu", "America/New_York"])
@pytest.mark.parametrize("session_zone", ["America/New_York", "UTC"])
def test_keys_equal_the_zone_database(spark, zone, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        local = timekeys.local_seconds(F.col("id"), zone)
        rows = spark.range(-10**10, 99_999_999_999, 29_654_321).withColumn("local", local).select(
            "id", timekeys.hour_key(F.col("local")).alias("hour"))
        rows = rows.withColumn("day", timekeys.day_of(F.col("hour"))).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    for row in rows:
        expected = (EPOCH + timedelta(seconds=row["id"])).astimezone(ZoneInfo(zone))
        assert row["hour"] == int(expected.strftime("%Y%m%d%H"))
        assert row["day"] == int(expected.strftime("%Y%m%d"))
