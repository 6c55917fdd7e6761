import json
from datetime import datetime, timezone

import pytest

from flowtally.operators import decode, hls
from flowtally.plans.base import base
from flowtally.schemas import HLS_RECORD, HLS_TOPIC, RTMP_TOPIC
from flowtally.sources import archive, kafka, mq
from samples import PLAYLIST, SEGMENT, SESSION, UPSTREAM_PLAYLIST


def test_route_by_topic_then_key(spark):
    rows = [("nodeHls", "nodeHls", 1), ("nodeHls", None, 2), (None, "nodeHls", 3),
            ("nodeHls", "RtmpFluence", 4), (None, None, 5)]
    routed = decode.route(spark.createDataFrame(rows, "key string, topic string, id int"), "nodeHls")
    assert {r["id"] for r in routed.collect()} == {1, 2, 3}


def test_decode(frame):
    cases = {
        '{"http_stat": 200}': False, "{}": False, '{"http_stat": null}': False,
        '{"http_stat": 200, "http_stat": 404}': False, ' {"a": [1, {"b": 2}]} ': False,
        '{"http_stat": "200"}': False, '{"http_stat": 200} tail': True, "{}{}": True,
        "{},{}": True, "": True, "  ": True, None: True, "null": True, "[1]": True,
        "[{}]": True, "12": True, '{"http_stat": 2': True, "{'http_stat': 200}": True,
    }
    rows = decode.decode(frame(HLS_TOPIC, list(cases)), HLS_RECORD).collect()
    assert {r["value"]: r["malformed"] for r in rows} == cases


def test_pages(spark):
    def page(*bodies):
        entries = [{"body": b, "offset": 10 + i} for i, b in enumerate(bodies)]
        return json.dumps({"nextOffset": 99, "list": entries})
    pages = [
        (0, page('{"b": 1, "a": "x"}', '{\\"k\\": [1, 2]}', "junk", '{"a": 1} tail')),
        (1, page()), (2, "no page"), (3, json.dumps({"nextOffset": 3})),
        (4, json.dumps({"list": [{"offset": 7}]})), (5, page("12", '{"a":1,"a":2}')),
        (6, page("1],[2", '{"x": 1.0, "a":  [1e3, 12345678901234567890123456789012345678901]}')),
    ]
    messages = mq.explode_pages(spark.createDataFrame(pages, "partition int, value string"))
    good, bad = mq.split_normalised(mq.normalise(messages))
    assert {(r["partition"], r["offset"], r["value"]) for r in good.collect()} == {
        (0, 10, '{"a":"x","b":1}'), (0, 11, '{"k":[1,2]}'), (5, 10, "12"), (5, 11, '{"a":2}'),
        (6, 11, '{"x":1.0,"a":[1e3,12345678901234567890123456789012345678901]}')}
    assert {(r["partition"], r["offset"], r["reject"]) for r in bad.collect()} == {
        (0, 12, "malformed_json"), (0, 13, "malformed_json"), (2, None, "bad_page"),
        (3, None, "bad_page"), (4, 7, "malformed_json"), (6, 10, "malformed_json")}
    assert {r["body"] for r in bad.collect() if r["offset"] is None} == {"no page", '{"nextOffset": 3}'}
    positions = mq.next_positions(spark.createDataFrame(pages, "partition int, value string"))
    assert {r["partition"]: r["nextOffset"] for r in positions.collect()} == {
        0: 99, 1: 99, 2: None, 3: 3, 4: None, 5: 99, 6: 99}
    assert mq.as_frame(good, HLS_TOPIC).columns == [
        "key", "value", "topic", "partition", "offset", "timestamp"]


def test_kafka_options():
    assert kafka.read_options("a:1,b:2", max_offsets=kafka.offsets_per_trigger(10_000, 3, 300)) == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "nodeHls,RtmpFluence",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "9000000"}
    assert kafka.read_options("a:1", ["t"], "earliest", min_partitions=64)["minPartitions"] == "64"


def test_publish_frame(frame):
    messages = frame(HLS_TOPIC, [SEGMENT])
    keyed = kafka.publish_frame(messages, HLS_TOPIC)
    assert keyed.columns == ["topic", "key", "value"]
    assert keyed.first()["key"] == HLS_TOPIC
    assert kafka.publish_frame(messages, HLS_TOPIC, key=None).first()["key"] is None
    with pytest.raises(ValueError):
        kafka.publish_frame(messages, HLS_TOPIC, key="user")


def test_archive_round_trip(spark, frame, folder):
    other_day = {**PLAYLIST, "unix_time": "1700090399"}
    path = folder("archive")
    archive.write(frame(HLS_TOPIC, [UPSTREAM_PLAYLIST, SEGMENT, other_day]), path)
    archive.write(frame(RTMP_TOPIC, [SESSION]), path, gather=True)
    counts = {(r["topic"], r["day"]): r["count"]
              for r in archive.read(spark, path).groupBy("topic", "day").count().collect()}
    assert counts == {(HLS_TOPIC, 20231115): 2, (HLS_TOPIC, 20231116): 1, (RTMP_TOPIC, 20231115): 1}
    replayed = archive.replay(spark, path, HLS_TOPIC, 20231115)
    direct = base(hls.requests(frame(HLS_TOPIC, [UPSTREAM_PLAYLIST, SEGMENT])), "hls")
    assert sorted(base(hls.requests(replayed), "hls").collect()) == sorted(direct.collect())
    plan = replayed._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan


def test_replay_of_double_encoded_lines(frame):
    wrapped = json.dumps(json.dumps(SEGMENT))
    unwrapped = decode.unwrap_double_encoded(
        frame(HLS_TOPIC, [wrapped, json.dumps(SEGMENT), wrapped + ',"x"', wrapped + '],["x"']))
    assert hls.requests(unwrapped).count() == 2


def test_event_day(frame):
    cases = {
        '{"unix_time": "1700003456"}': 20231115, '{"unix_time": 1700003456}': 20231115,
        '{"unix_time": 1700003456.9}': 20231115, '{"unix_time": "1700003456.9"}': None,
        '{"unix_time": "x"}': None, '{"unix_time": null}': None, "[1]": None, "junk": None,
        "12": None, '{"unix_time": 1}{}': None, None: None,
    }
    messages = frame(HLS_TOPIC, list(cases))
    dated = {r["value"]: r["day"] for r in archive.with_event_day(messages).collect()}
    assert dated == cases
    rejected = {r["value"] for r in archive.rejects(messages).collect()}
    assert rejected == {text for text, day in cases.items() if day is None}


def test_event_day_defaults_to_today(frame):
    before = datetime.now(timezone.utc)
    day = archive.with_event_day(frame(RTMP_TOPIC, ["{}"]), tz="UTC").first()["day"]
    assert int(before.strftime("%Y%m%d")) <= day <= int(
        datetime.now(timezone.utc).strftime("%Y%m%d"))


def test_line_breaks_between_tokens_survive_the_archive(spark, frame, folder):
    archive.write(frame(HLS_TOPIC, [json.dumps(SEGMENT, indent=1)]), folder("a"))
    assert hls.requests(archive.replay(spark, folder("a"), HLS_TOPIC, 20231115)).count() == 1
