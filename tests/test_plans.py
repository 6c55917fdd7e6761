import json
import re

import pytest
from pyspark.sql import functions as F

from flowtally_checks import feeds
from flowtally.operators import hls, progress, rtmp
from flowtally.plans import base, cascade, rollups, upkeep
from flowtally.schemas import HLS_METRICS

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def counters(spark):
    frame = feeds.mixed_messages(feeds.events(spark, DATA))
    return {"hls": hls.requests(frame).persist(), "rtmp": rtmp.sessions(frame).persist()}


def _rows(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("feed", ["hls", "rtmp"])
def test_one_pass_equals_separate_rollups(counters, feed):
    levels = rollups.all_levels(base.base(counters[feed], feed), feed).persist()
    for name, spec in rollups.CATALOGUE.items():
        if spec.feed == feed:
            assert _rows(rollups.serve(levels, name)) == _rows(
                rollups.rollup(counters[feed], name)), name
    levels.unpersist()


def test_rollup_of_partials_equals_rollup_of_rows(counters):
    partials = base.base(counters["hls"], "hls")
    for name in ("hls_down_a", "hls_down_user_hour", "hls_stream_data"):
        assert _rows(rollups.rollup(partials, name)) == _rows(
            rollups.rollup(counters["hls"], name))


def test_cascade_from_parents_equals_direct(counters):
    tables = cascade.cascade(base.base(counters["hls"], "hls"))
    for name in cascade.STEPS:
        assert _rows(tables[name]) == _rows(cascade.rekey(counters["hls"], name)), name


def test_totals_are_the_same_at_every_level(counters):
    def totals(df, metrics=("flux", "counts", "valid_counts", "fluency_counts")):
        return tuple(df.agg(*[F.sum(m) for m in metrics]).first())
    whole = totals(counters["hls"])
    for name, (_, _, metrics) in cascade.STEPS.items():
        if metrics == HLS_METRICS:
            assert totals(cascade.rekey(counters["hls"], name)) == whole, name
    detail = {name: rollups.rollup(counters["hls"], name) for name in (
        "hls_down_user", "hls_down_app_stream", "hls_down_httpcode", "hls_down_user_hour",
        "hls_down_app_stream_hour")}
    assert len({totals(df) for df in detail.values()}) == 1


def test_odd_server_types_count_only_in_totals(frame):
    record = {"request_url": "GET /a/b.m3u8 H", "svr_type": 2, "body_bytes_sent": 9}
    requests = hls.requests(frame("nodeHls", [record]))
    assert rollups.rollup(requests, "hls_down").first()["flux"] == 9
    assert rollups.rollup(requests, "hls_down_user").count() == 0
    levels = rollups.all_levels(requests, "hls")
    assert {r["level"] for r in levels.collect()} == {
        "total-day", "total-day-app", "total-day-server_addr"}


def test_unparsed_urls_count_on_the_playlist_side(frame):
    requests = hls.requests(frame("nodeHls", [{"request_url": "GET /broken.ts"}]))
    row = rollups.rollup(requests, "hls_down").first()
    assert (row["counts_m3"], row["counts_ts"]) == (1, 0)


def test_rollup_is_one_shuffle_of_pruned_columns(counters, spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    requests = hls.requests(feeds.mixed_messages(events))
    plan = rollups.rollup(requests, "hls_down_a")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_sum" in plan
    assert "RtmpFluence" not in plan


def test_increment_or_insert(spark):
    existing = spark.createDataFrame([(1, "a", 5), (1, None, 1)], "t bigint, k string, n bigint")
    delta = spark.createDataFrame([(7, "a", 1), (9, None, 1), (3, "b", 2)], "n bigint, k string, t bigint")
    merged = base.increment_or_insert(existing, delta, ["t", "k"])
    assert {tuple(r) for r in merged.collect()} == {(1, "a", 12), (1, None, 10), (2, "b", 3)}


def test_duplicate_keys_and_repair(spark):
    rows = spark.createDataFrame(
        [(1, "a", 2, 20), (1, "a", 1, 10), (1, None, 1, 7), (1, None, 3, 8), (2, "a", 1, 5)],
        "t int, k string, seq int, n int")
    assert {tuple(r) for r in upkeep.duplicate_keys(rows, ["t", "k"]).collect()} == {
        (1, "a", 2), (1, None, 2)}
    assert {tuple(r) for r in upkeep.drop_duplicates(rows, ["t", "k"], "seq").collect()} == {
        (1, "a", 1, 10), (1, None, 1, 7), (2, "a", 1, 5)}


def test_lag(spark):
    offsets = spark.createDataFrame([(0, 10, 5, 100), (1, 10, 40, 40), (2, 0, 7, 9)],
                                    "partition int, startOffset bigint, offset bigint, lastOffset bigint")
    got = {r["partition"]: (r["offset"], r["clamped"], r["backlog"], r["has_new"])
           for r in progress.lag(offsets).collect()}
    assert got == {0: (10, True, 90, True), 1: (40, False, 0, False), 2: (7, False, 2, True)}


@pytest.mark.parametrize("limit", [100_000, 0])
def test_reached_day(spark, monkeypatch, limit):
    monkeypatch.setattr(progress, "BROADCAST_PARTITIONS", limit)
    rows = [(p, o, "nodeHls", "nodeHls", json.dumps({"unix_time": str(1704067200 + 86400 * o)}))
            for p, o in [(0, 1), (0, 2), (0, 4), (0, 9), (1, 9), (2, 0)]]
    messages = spark.createDataFrame(
        rows, "partition int, offset bigint, key string, topic string, value string")
    offsets = spark.createDataFrame([(0, 3), (1, 10), (2, 0)], "partition int, offset bigint")
    assert {tuple(r) for r in progress.reached_day(messages, offsets).collect()} == {
        (0, 3, 4, 20240105), (2, 0, 0, 20240101)}


def test_reduce_keys(counters):
    detail = rollups.rollup(counters["rtmp"], "rtmp_down_app_stream")
    coarse = rollups.reduce_keys(detail, ["timestamp", "app", "stream"])
    assert set(coarse.columns) == {
        "timestamp", "app", "stream", "flux", "valid_counts", "total_counts"}
    assert coarse.agg(F.sum("flux")).first()[0] == detail.agg(F.sum("flux")).first()[0]


def test_generated_code_can_be_compiled_just_in_time(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    frame = feeds.mixed_messages(events)
    requests, sessions = hls.requests(frame), rtmp.sessions(frame)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in (base.base(requests, "hls"), base.base(sessions, "rtmp"),
                   rollups.rollup(requests, "hls_down_a"), rollups.all_levels(requests, "hls"),
                   rollups.all_levels(sessions, "rtmp")):
            text = df._jdf.queryExecution().explainString(mode)
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:\s*(\d+)", text)]
            assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_key_with_a_third_of_all_rows(spark):
    ids = spark.range(0, 30_000, 1, 6)
    app = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 500))
    value = F.to_json(F.struct(
        F.concat(F.lit("GET /"), app, F.lit("/s.m3u8 HTTP/1.1")).alias("request_url"),
        F.col("id").alias("body_bytes_sent")))
    frame = ids.select(
        F.lit("nodeHls").alias("key"), value.alias("value"), F.lit("nodeHls").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"),
        F.current_timestamp().alias("timestamp"))
    table = rollups.rollup(hls.requests(frame), "hls_down_a")
    rows = {r["app"]: (r["counts_m3"], r["flux"]) for r in table.collect()}
    assert rows["hot"] == (10_000, sum(range(0, 30_000, 3)))
    assert sum(n for n, _ in rows.values()) == 30_000
    assert sum(flux for _, flux in rows.values()) == sum(range(30_000))


@pytest.mark.parametrize("name", ["hls_base", "hls_all_levels", "rtmp_base", "rtmp_all_levels", "rtmp_down"])
def test_generated_methods_stay_below_the_limit_of_the_jit(spark, name):
    from flowtally_checks.queries import QUERIES

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
        stages = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sizes and max(sizes) < 8000
