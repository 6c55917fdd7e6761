import json
import os

import pytest
from pyspark.sql import functions as F

from flowtally.operators import hls, rtmp
from flowtally.plans import rollups
from flowtally.plans.base import base, fold
from flowtally.schemas import FRAME, HLS_TOPIC, RTMP_TOPIC
from flowtally.sources import archive
from flowtally.streaming import partials, served
from samples import PLAYLIST, SEGMENT, SESSION, UPSTREAM_PLAYLIST

HLS = [UPSTREAM_PLAYLIST, SEGMENT, PLAYLIST, {**SEGMENT, "request_time": "9.9"}]
LATE = {**SEGMENT, "unix_time": "1400000000"}


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture
def inbox(folder, tmp_path):
    """A folder of JSON message files, one per call, in order."""
    state = {"n": 0}
    (tmp_path / "inbox").mkdir()

    def drop(messages):
        state["n"] += 1
        lines = [
            json.dumps({"key": topic, "topic": topic, "partition": 0, "offset": state["n"] * 100 + i,
                        "value": r if isinstance(r, str) else json.dumps(r)})
            for i, (topic, r) in enumerate(messages)
        ]
        file = tmp_path / "inbox" / f"{state['n']:03}.json"
        file.write_text("\n".join(lines))
        # The file source takes files in the order of their time.
        os.utime(file, (1_700_000_000 + state["n"],) * 2)
    drop.path = folder("inbox")
    return drop


def _stream(spark, inbox):
    return spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).json(inbox.path)


def _run(spark, inbox, folder, feed, run="first", rejects=True):
    query = partials.start_partials(
        _stream(spark, inbox), feed, folder(f"{feed}-partials"), folder(f"{feed}-checkpoint-{run}"),
        run, rejects_path=folder(f"{feed}-rejects") if rejects else None, availableNow=True)
    query.awaitTermination()
    return partials.read_partials(spark, folder(f"{feed}-partials"), feed)


def test_stream_equals_batch_for_both_feeds(spark, inbox, folder, frame):
    for record in HLS:
        inbox([(HLS_TOPIC, record), (RTMP_TOPIC, SESSION)])
    inbox([(HLS_TOPIC, "junk"), (RTMP_TOPIC, "{}")])
    got = _run(spark, inbox, folder, "hls")
    assert got.select("batch_id").distinct().count() == 4
    assert _rows(fold(got, "hls")) == _rows(base(hls.requests(frame(HLS_TOPIC, HLS)), "hls"))
    got = _run(spark, inbox, folder, "rtmp")
    assert _rows(fold(got, "rtmp")) == _rows(
        base(rtmp.sessions(frame(RTMP_TOPIC, [SESSION] * 4)), "rtmp"))
    rejected = spark.read.parquet(folder("hls-rejects")).collect()
    assert [(r["reject"], r["value"]) for r in rejected] == [("malformed_json", "junk")]
    rejected = spark.read.parquet(folder("rtmp-rejects")).collect()
    assert [r["reject"] for r in rejected] == ["missing_field"]


def test_repeated_batch_changes_nothing(spark, frame, folder):
    batch = frame(HLS_TOPIC, HLS + [LATE])
    for _ in range(2):
        partials.account_batch(batch, 7, "hls", folder("p"), "first", folder("r"))
    partials.account_batch(batch, 8, "hls", folder("p"), "first")
    got = partials.read_partials(spark, folder("p"), "hls")
    assert got.filter("batch_id = 7").agg(F.sum("counts")).first()[0] == 5
    assert got.agg(F.sum("counts")).first()[0] == 10


def test_restart_continues_and_new_run_does_not_overwrite(spark, inbox, folder):
    inbox([(HLS_TOPIC, SEGMENT)])
    _run(spark, inbox, folder, "hls", rejects=False)
    inbox([(HLS_TOPIC, PLAYLIST)])
    got = _run(spark, inbox, folder, "hls", rejects=False)
    assert got.agg(F.sum("counts")).first()[0] == 2
    got = _run(spark, inbox, folder, "hls", run="second", rejects=False)
    assert got.agg(F.sum("counts")).first()[0] == 4


def test_late_messages_land_in_their_own_day(spark, inbox, folder):
    inbox([(HLS_TOPIC, SEGMENT)])
    inbox([(HLS_TOPIC, LATE), (HLS_TOPIC, SEGMENT)])
    got = _run(spark, inbox, folder, "hls")
    days = {(r["day"], r["batch_id"]): r["counts"] for r in got.collect()}
    assert days == {(20231115, 0): 1, (20140514, 1): 1, (20231115, 1): 1}
    served.refresh(spark, "hls", folder("hls-partials"), folder("rollups"))
    table = served.table(spark, folder("rollups"), "hls_down")
    assert {(r["timestamp"], r["counts_ts"]) for r in table.collect()} == {
        (20231115, 2), (20140514, 1)}


@pytest.mark.parametrize("feed, operator, topic, records", [
    ("hls", hls.requests, HLS_TOPIC, HLS + [LATE]),
    ("rtmp", rtmp.sessions, RTMP_TOPIC, [SESSION, {**SESSION, "Cmd": "publish"}]),
])
def test_served_tables_equal_direct_rollups(spark, frame, folder, feed, operator, topic, records):
    batch = frame(topic, records)
    partials.account_batch(batch, 0, feed, folder("p"), "first")
    served.refresh(spark, feed, folder("p"), folder("s"))
    for name, spec in rollups.CATALOGUE.items():
        if spec.feed == feed:
            assert _rows(served.table(spark, folder("s"), name)) == _rows(
                rollups.rollup(operator(batch), name)), name


def test_refresh_of_touched_days_only(spark, frame, folder):
    partials.account_batch(frame(HLS_TOPIC, [SEGMENT, LATE]), 0, "hls", folder("p"), "first")
    served.refresh(spark, "hls", folder("p"), folder("s"))
    partials.account_batch(frame(HLS_TOPIC, [SEGMENT]), 1, "hls", folder("p"), "first")
    touched = served.touched_days(spark, folder("p"), "hls", "first", [1])
    assert [r["day"] for r in touched.collect()] == [20231115]
    for days in (touched, touched, [20231115]):
        served.refresh(spark, "hls", folder("p"), folder("s"), days)
        table = served.table(spark, folder("s"), "hls_down")
        assert {(r["timestamp"], r["counts_ts"]) for r in table.collect()} == {
            (20231115, 2), (20140514, 1)}


def test_purge_and_backfill_of_a_day(spark, frame, folder):
    messages = frame(HLS_TOPIC, HLS + [LATE])
    archive.write(messages, folder("archive"))
    partials.account_batch(messages, 0, "hls", folder("p"), "first")
    served.refresh(spark, "hls", folder("p"), folder("s"))
    before = _rows(served.table(spark, folder("s"), "hls_down_app_stream_hour"))

    mode = "spark.sql.sources.partitionOverwriteMode"
    spark.conf.set(mode, "dynamic")
    try:
        served.purge_partials(spark, "hls", folder("p"), 20231115)
        served.purge_rollups(spark, "hls", folder("s"), 20231115)
    finally:
        spark.conf.unset(mode)
    assert partials.read_partials(spark, folder("p"), "hls").filter("day = 20231115").count() == 0
    left = served.table(spark, folder("s"), "hls_down_app_stream_hour").collect()
    assert [r["timestamp"] // 100 for r in left] == [20140514]

    replayed = archive.replay(spark, folder("archive"), HLS_TOPIC, 20231115)
    partials.account_batch(replayed, 0, "hls", folder("p"), "backfill")
    served.refresh(spark, "hls", folder("p"), folder("s"), [20231115])
    assert _rows(served.table(spark, folder("s"), "hls_down_app_stream_hour")) == before


def test_archive_stream_and_replay_stream(spark, inbox, folder):
    inbox([(HLS_TOPIC, SEGMENT), (HLS_TOPIC, LATE)])
    inbox([(HLS_TOPIC, PLAYLIST), (RTMP_TOPIC, SESSION)])
    for _ in range(2):
        archive.write_stream(_stream(spark, inbox), folder("archive"), folder("checkpoint"), "first",
                             folder("unplaced"), availableNow=True).awaitTermination()
        inbox([(HLS_TOPIC, '{"unix_time": "never"}'), (HLS_TOPIC, LATE)])
    archive.write(_messages(spark, [PLAYLIST]), folder("archive"))
    for _ in range(2):
        archive.write(_messages(spark, [SEGMENT]), folder("archive"), run="again", batch_id=3)
    assert archive.replay(spark, folder("archive"), HLS_TOPIC, 20231115).count() == 4
    again = archive.replay_stream(spark, folder("archive"), HLS_TOPIC, 20231115, max_files=1)
    partials.start_partials(again, "hls", folder("p"), folder("replay-checkpoint"), "replay",
                            availableNow=True).awaitTermination()
    got = partials.read_partials(spark, folder("p"), "hls")
    assert got.agg(F.sum("counts")).first()[0] == 4
    archive.write_stream(_stream(spark, inbox), folder("archive"), folder("checkpoint"), "first",
                         folder("unplaced"), availableNow=True).awaitTermination()
    assert spark.read.parquet(folder("unplaced")).select("value").collect()[0][0] == '{"unix_time": "never"}'


def _messages(spark, records):
    rows = [(HLS_TOPIC, json.dumps(r), HLS_TOPIC, 0, i, None) for i, r in enumerate(records)]
    return spark.createDataFrame(rows, FRAME)


def test_a_rewritten_batch_leaves_its_last_input_only(spark, frame, folder):
    partials.account_batch(frame(HLS_TOPIC, [SEGMENT, LATE]), 0, "hls", folder("p"), "first", folder("r"))
    partials.account_batch(frame(HLS_TOPIC, [SEGMENT, "junk"]), 0, "hls", folder("p"), "first", folder("r"))
    got = partials.read_partials(spark, folder("p"), "hls")
    assert [(r["day"], r["counts"]) for r in got.collect()] == [(20231115, 1)]
    partials.account_batch(frame(HLS_TOPIC, [SEGMENT]), 0, "hls", folder("p"), "first", folder("r"))
    assert spark.read.schema("value string, reject string").parquet(folder("r")).count() == 0


def test_a_rebuilt_day_keeps_no_stale_level(spark, frame, folder):
    partials.account_batch(frame(HLS_TOPIC, [SEGMENT]), 0, "hls", folder("p"), "first")
    served.refresh(spark, "hls", folder("p"), folder("s"))
    assert served.table(spark, folder("s"), "hls_down_user").count() == 1
    # A server type of 2 counts in totals only.
    partials.account_batch(frame(HLS_TOPIC, [{**SEGMENT, "svr_type": 2}]), 0, "hls", folder("p"), "first")
    served.refresh(spark, "hls", folder("p"), folder("s"), [20231115])
    assert served.table(spark, folder("s"), "hls_down_user").count() == 0
    assert served.table(spark, folder("s"), "hls_down").count() == 1


def test_served_tables_follow_the_partial_sums(spark, frame, folder):
    def follow():
        served.follow(spark, "hls", folder("p"), folder("s"), folder("c"), availableNow=True).awaitTermination()
        return {(r["timestamp"], r["counts_ts"]) for r in served.table(spark, folder("s"), "hls_down").collect()}

    partials.account_batch(frame(HLS_TOPIC, [SEGMENT, LATE]), 0, "hls", folder("p"), "first")
    assert follow() == {(20231115, 1), (20140514, 1)}
    partials.account_batch(frame(HLS_TOPIC, [SEGMENT]), 1, "hls", folder("p"), "first")
    assert follow() == {(20231115, 2), (20140514, 1)}
    assert follow() == {(20231115, 2), (20140514, 1)}


def test_stored_levels_are_pruned(spark, frame, folder):
    partials.account_batch(frame(HLS_TOPIC, HLS), 0, "hls", folder("p"), "first")
    served.refresh(spark, "hls", folder("p"), folder("s"))
    daily = served.table(spark, folder("s"), "hls_down_user").filter("timestamp = 20231115")
    hourly = served.table(spark, folder("s"), "hls_down_user_hour", days=[20231115])
    for table in (daily, hourly):
        plan = table._jdf.queryExecution().executedPlan().toString()
        pruned, pushed = plan.split("PartitionFilters")[1].split("PushedFilters")[:2]
        assert "day#" in pruned and "EqualTo(level" in pushed
    assert hourly.count() == 1
