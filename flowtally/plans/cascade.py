"""The access-log cascade: finest sums re-keyed step by step to coarser ones."""

from pyspark.sql import functions as F

from flowtally.functions.timekeys import day_of
from flowtally.plans.base import total
from flowtally.schemas import HLS_METRICS

# Table -> (table it can be derived from, keys, counters).
# ``timestamp`` is the day key, ``timestamp_hour`` the hour key.
_FEW = ["fluency_counts", "valid_counts", "counts"]
STEPS = {
    "hls_server": ("base", ["svr_type", "timestamp", "server_addr"], HLS_METRICS),
    "hls_http_code": ("base", ["svr_type", "timestamp", "http_stat"], _FEW),
    "hls_app_stream_user_hour": (
        "base", ["svr_type", "hls_type", "timestamp_hour", "app", "stream", "user"], HLS_METRICS),
    "hls_app_stream_user": (
        "hls_app_stream_user_hour",
        ["svr_type", "hls_type", "timestamp", "app", "stream", "user"], HLS_METRICS),
    "hls_app": ("hls_app_stream_user", ["svr_type", "hls_type", "timestamp", "app"], HLS_METRICS),
    "hls_user_hour": (
        "hls_app_stream_user_hour", ["svr_type", "hls_type", "timestamp_hour", "user"],
        HLS_METRICS),
    "hls_user": ("hls_user_hour", ["svr_type", "hls_type", "timestamp", "user"], HLS_METRICS),
}


def rekey(counters, name):
    """One table of the cascade from requests, base sums or a finer table.

    Sums of sums are sums, so the shortest way from raw requests is a single
    shuffle on the target key; the parent is only worth it once it exists.
    """
    _, keys, metrics = STEPS[name]
    if "timestamp" in keys and "timestamp" not in counters.columns:
        counters = counters.withColumn("timestamp", day_of(F.col("timestamp_hour")))
    kinds = dict(counters.dtypes)
    return counters.groupBy(*keys).agg(*[total(F.col(m), m, kinds[m]).alias(m) for m in metrics])


def cascade(base):
    """All tables, each from its parent. Persist or write ``base`` before using several."""
    tables = {"base": base}
    for name, (parent, _, _) in STEPS.items():
        tables[name] = rekey(tables[parent], name)
    return tables
