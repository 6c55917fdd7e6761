"""Hour and day keys (yyyyMMddHH, yyyyMMdd as numbers) in a given time zone.

Wall-clock times are kept as seconds, so the session time zone never changes
a key, and dates are only worked out as day numbers.
"""

from pyspark.sql import functions as F

DEFAULT_TZ = "Asia/Shanghai"


def local_seconds(epoch, tz=DEFAULT_TZ):
    """Epoch seconds (bigint) -> seconds between 1970-01-01 00:00 and the wall clock in ``tz``."""
    return F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(epoch), tz))


def hour_key(local):
    """Wall-clock seconds -> yyyyMMddHH. Keep ``local`` a column of its own: it is used often."""
    second_of_day = F.pmod(local, F.lit(86400))
    date = F.date_from_unix_date(
        F.call_function("div", local - second_of_day, F.lit(86400)).cast("int"))
    day = F.year(date).cast("bigint") * 10000 + F.month(date) * 100 + F.dayofmonth(date)
    return day * 100 + F.call_function("div", second_of_day, F.lit(3600))


def day_of(hour):
    """yyyyMMddHH -> yyyyMMdd."""
    return F.call_function("div", hour, F.lit(100))
