"""Headline timings: one JSON line with seconds per query.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

import json
import os
import time

from flowtally_checks.queries import QUERIES
from flowtally.operators import hls
from flowtally.plans import base, rollups
from flowtally.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM_UP_DIR = "/root/testdata/sf0.001"
HEADLINE = [
    "hls_base", "rtmp_base", "hls_down_a", "hls_down_app_stream_hour", "rtmp_down",
    "hls_all_levels", "rtmp_all_levels", "geo_lookup", "geo_lookup_16", "geo_lookup_shuffled",
    "mq_normalise", "archive_by_day", "replay_day", "fold_hls", "stream_hls_partials",
]


def run(query, spark, sf_dir):
    """Seconds to compute every row and column of a query."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def hls_separate_rollups(spark, sf_dir):
    """All HLS tables one by one from kept base sums, to hold against hls_all_levels."""
    from flowtally_checks import feeds

    messages = feeds.mixed_messages(feeds.events(spark, sf_dir))
    sums = base.base(hls.requests(messages), "hls").persist()
    start = time.perf_counter()
    for name, spec in rollups.CATALOGUE.items():
        if spec.feed == "hls":
            rollups.rollup(sums, name).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    sums.unpersist()
    return seconds


def main():
    spark = build_session(
        "flowtally-bench", master=f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
        spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    warm_up = WARM_UP_DIR if os.path.isdir(WARM_UP_DIR) else SF_DIR
    seconds = {}
    for name in HEADLINE:
        run(QUERIES[name], spark, warm_up)
        seconds[name] = round(min(run(QUERIES[name], spark, SF_DIR) for _ in range(2)), 3)
    messages = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    separate = round(hls_separate_rollups(spark, SF_DIR), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "messages": messages,
        "rows_per_sec": {name: round(messages / s) for name, s in seconds.items()},
        "hls_separate_rollups_sec": separate, "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
