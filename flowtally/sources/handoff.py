"""Partial sums as flat JSON records, for consumers that take them one by one.

The partial-sum tables are the engine's own hand-off. These records are the
text form of the same rows: one JSON object with keys and counters by name.
"""

from pyspark.sql import functions as F

from flowtally.operators.decode import decode
from flowtally.plans.base import COUNTERS, KEYS
from flowtally.schemas import FRACTIONAL, kind_of

# How the request kind is written in a record.
_KINDS = {"m3u8": "true", "ts": "false"}


def encode(sums, feed):
    """Partial sums -> rows with the record as ``value``; hours are written as text."""
    columns = []
    for name in [*KEYS[feed], *COUNTERS[feed]]:
        if name == "timestamp_hour":
            columns.append(F.lpad(F.col(name).cast("string"), 10, "0").alias(name))
        elif name in FRACTIONAL:
            columns.append(F.col(name).cast("double").alias(name))
        else:
            columns.append(F.col(name))
    value = F.to_json(F.struct(*columns))
    if feed == "hls":
        # Quotes inside a JSON string are escaped, so only the field itself can match.
        for kind, written in _KINDS.items():
            value = F.replace(value, F.lit(f'"hls_type":"{kind}"'), F.lit(f'"hls_type":{written}'))
    return sums.select(value.alias("value"))


def _record(feed):
    kinds = {"svr_type": "int", "http_stat": "int"}
    record = {name: kinds.get(name, "string") for name in KEYS[feed]}
    for name in COUNTERS[feed]:
        record[name] = kind_of(name)
    return record


def read(values, feed):
    """Rows with a record as ``value`` -> partial sums; (good, malformed)."""
    decoded = decode(values.select("value"), _record(feed))
    whole_hour = F.col("timestamp_hour").rlike(r"\A[0-9]{9,10}\z")
    usable = ~F.col("malformed") & F.coalesce(whole_hour, F.lit(False))
    good = decoded.filter(usable).withColumn("timestamp_hour", F.col("timestamp_hour").cast("bigint"))
    if feed == "hls":
        kind = F.col("hls_type")
        good = good.withColumn(
            "hls_type", F.when(kind == "true", "m3u8").when(kind == "false", "ts").otherwise(kind))
    if feed == "rtmp":
        good = good.withColumn("user", F.coalesce("user", F.lit("-1")))
    return good.select(*KEYS[feed], *COUNTERS[feed]), decoded.filter(~usable).select("value")
