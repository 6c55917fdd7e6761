import json

from flowtally.operators import hls, rtmp
from flowtally.plans.base import base
from flowtally.schemas import HLS_TOPIC, RTMP_TOPIC
from flowtally.sources import handoff
from samples import PLAYLIST, SEGMENT, SESSION, UPSTREAM_PLAYLIST


def test_hls_records(frame):
    tricky = {**PLAYLIST, "request_url": 'GET /"hls_type":"m3u8"/x.m3u8 HTTP/1.1'}
    broken = {"request_url": "GET /broken.ts"}
    sums = base(hls.requests(frame(HLS_TOPIC, [UPSTREAM_PLAYLIST, SEGMENT, tricky, broken])), "hls")
    encoded = handoff.encode(sums, "hls")
    records = [json.loads(r["value"]) for r in encoded.collect()]
    assert sorted(str(r["hls_type"]) for r in records) == ["False", "True", "True", "error"]
    assert {r["timestamp_hour"] for r in records} == {"2023111507", "1970010108"}
    assert '"hls_type":"m3u8"' in {r["app"] for r in records}
    good, bad = handoff.read(encoded, "hls")
    assert sorted(good.collect()) == sorted(sums.collect())
    assert bad.count() == 0


def test_rtmp_records(spark, frame):
    sums = base(rtmp.sessions(frame(RTMP_TOPIC, [SESSION, SESSION])), "rtmp")
    encoded = handoff.encode(sums, "rtmp")
    good, _ = handoff.read(encoded, "rtmp")
    assert good.collect() == sums.collect()
    assert good.dtypes == sums.dtypes
    texts = spark.createDataFrame([("junk",), ('{"timestamp_hour": "x"}',)], "value string")
    good, bad = handoff.read(texts, "rtmp")
    assert (good.count(), bad.count()) == (0, 2)
