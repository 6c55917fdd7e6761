import pytest
from pyspark.sql import functions as F

from flowtally.operators import hls
from flowtally.plans.base import base
from flowtally.schemas import HLS_TOPIC
from samples import PLAYLIST, SEGMENT, UPSTREAM_PLAYLIST


def _request(url, **fields):
    return {"request_url": url, "http_stat": 200, "request_time": "0.5", "body_bytes_sent": 7,
            "unix_time": "1700003200", "server_addr": "s", **fields}


def _derive(frame, records, **options):
    derived = hls.derive(hls.accept(hls.read(frame(HLS_TOPIC, records))), **options)
    return {r["offset"]: r for r in derived.collect()}


def test_golden_rows(frame):
    rows = base(hls.requests(frame(HLS_TOPIC, [UPSTREAM_PLAYLIST, SEGMENT, PLAYLIST])), "hls")
    got = {tuple(r) for r in rows.collect()}
    assert got == {
        (1, "m3u8", 2023111507, "harbor", "camera", "17", "192.0.2.15", 200,
         0, 0, 0, 412, 4, 1, 1, 1),
        (0, "ts", 2023111507, "summit", "east", "no_user_keyword", "192.0.2.44", 200,
         0, 0, 0, 90210, 0, 1, 1, 1),
        (0, "m3u8", 2023111507, "valley", "valley", "no_user_keyword", "198.51.100.21", 200,
         0, 0, 0, 318, 3, 1, 1, 1),
    }


def test_urls(frame):
    cases = [
        ("GET http://pier/pier-deck-1650001000-1650001999123-2750.ts HTTP/1.1", "ts", "pier", "deck", "2750"),
        ("GET /204/204-lamp-1650002000-1650002888-1875.ts HTTP/1.1", "ts", "204", "lamp", "1875"),
        ("GET //a//b.m3u8 HTTP/1.1", "m3u8", "a", "b", None),
        ("GET /live.m3u8 HTTP/1.1", "m3u8", "live.m3u8", "HTTP", None),
        ("GET http://h/a/s.m3u8 HTTP/1.1", "m3u8", "http:", "h", None),
        ("GET /broken.ts", "error", "error", "error", None),
        ("GET /a/nodash.ts HTTP/1.1", "error", "error", "error", "nodash"),
        ("GET /a/b.m3u8.ts HTTP/1.1", "m3u8", "a", "b", None),
        ("x.m3u8", "error", "error", "error", None),
    ]
    rows = _derive(frame, [_request(case[0]) for case in cases])
    for i, (url, kind, app, stream, length) in enumerate(cases):
        assert (rows[i]["hls_type"], rows[i]["app"], rows[i]["stream"]) == (kind, app, stream), url
        if kind == "ts":
            assert rows[i]["slice"] == length
        if kind == "error":
            assert rows[i]["fluency_counts"] == 0 and rows[i]["counts"] == 1


def test_only_media_requests_count(frame):
    records = [_request("GET /favicon.ico HTTP/1.1"), {"http_stat": 200}, _request("GET /a/b.m3u8 H")]
    assert set(_derive(frame, records)) == {2}


def test_status_decides_validity(frame):
    url = "GET /a/b.m3u8 HTTP/1.1"
    rows = _derive(frame, [_request(url, http_stat=s) for s in (200, 202, 302, 399, 400, 404, 500)]
                   + [{k: v for k, v in _request(url).items() if k != "http_stat"}])
    got = [(r["valid_counts"], r["nlt_400_counts"], r["flux"]) for _, r in sorted(rows.items())]
    assert got == [(1, 0, 7), (0, 0, 0), (1, 0, 7), (1, 0, 7), (0, 1, 0), (0, 1, 0), (0, 1, 0), (1, 0, 7)]
    assert rows[7]["http_stat"] == 0


def test_request_time(frame):
    cases = [
        ("0.999", 999, 0, 0, 1), ("1.000", 1000, 0, 0, 0), ("1.001", 1000, 0, 0, 0),
        ("1.002", 1002, 1, 0, 0), ("3.5", 3500, 1, 1, 0), (0.25, 250, 0, 0, 1), (2, 2000, 1, 0, 0),
        (1e-05, 0, 0, 0, 1), (" 0.5 ", 500, 0, 0, 1), ("3.0", 3000, 1, 0, 0),
    ]
    rows = _derive(frame, [_request("GET /a/b.m3u8 H", request_time=case[0]) for case in cases])
    for i, (seconds, *expected) in enumerate(cases):
        got = [rows[i][c] for c in ("request_time", "mt_1_counts", "mt_3_counts", "fluency_counts")]
        assert got == expected, seconds


def test_segment_smoothness(frame):
    url = "GET /a/a-s-1-{}.ts HTTP/1.1"
    records = [_request(url.format(n), request_time="1.0") for n in ("3001", "3000", "x9")]
    records.append(_request(url.format("9000"), http_stat=404))
    numeric = _derive(frame, records)
    assert [numeric[i]["fluency_counts"] for i in range(4)] == [1, 0, 0, 0]
    text = _derive(frame, records, slice_compare="text")
    assert [text[i]["fluency_counts"] for i in range(4)] == [1, 1, 1, 0]


def test_user(frame):
    cases = {
        "007": "7", 12: "12", "guest": "guest", " 5 ": "5", "-3": "-3", "12.7": "12.7",
        None: "no_user_keyword", "": "", "99999999999999999999": "99999999999999999999",
    }
    rows = _derive(frame, [_request("GET /a/b.m3u8 H", user=user) for user in cases])
    assert [rows[i]["user"] for i in range(len(cases))] == list(cases.values())


def test_time_zone_and_missing_time(frame):
    url = "GET /a/b.m3u8 HTTP/1.1"
    missing = {k: v for k, v in _request(url).items() if k != "unix_time"}
    records = [_request(url), missing, _request(url, unix_time="1700003456.75"),
               _request(url, unix_time=1700003456.5), _request(url, unix_time=0)]
    local = _derive(frame, records)
    assert [local[i]["timestamp_hour"] for i in range(5)] == [
        2023111507, 1970010108, 2023111507, 2023111507, 1970010108]
    utc = _derive(frame, records, tz="UTC")
    assert [utc[i]["timestamp_hour"] for i in range(2)] == [2023111423, 1970010100]


def test_rejects_keep_the_message(frame):
    url = "GET /a/b.m3u8 HTTP/1.1"
    records = [
        "not json", _request(url, request_time="-"), _request(url, unix_time="abc"),
        _request(url, unix_time="1700003456000"), _request(url, request_time="1d"),
        _request(url, request_time="NaN"), _request(url, body_bytes_sent=2**64),
        _request("GET /favicon.ico", request_time="-"), _request(url, request_time="1e20"),
        _request(url), None, _request(url, body_bytes_sent="much"),
        '{"request_url":"GET /a/b.m3u8","http_stat":200}],"y":[1',
        '{"request_url":"GET /a/b.m3u8"}],"record":[{"http_stat":2}',
    ]
    decoded = hls.read(frame(HLS_TOPIC, records))
    rejected = {r["offset"]: (r["reject"], r["value"]) for r in hls.rejects(decoded).collect()}
    assert {k: v[0] for k, v in rejected.items()} == {
        0: "malformed_json", 1: "bad_request_time", 2: "bad_unix_time", 3: "bad_unix_time",
        4: "bad_request_time", 5: "bad_request_time", 6: "bad_body_bytes_sent",
        8: "bad_request_time", 10: "malformed_json", 11: "bad_body_bytes_sent",
        12: "malformed_json", 13: "malformed_json",
    }
    assert rejected[0][1] == "not json"
    assert [r["offset"] for r in hls.accept(decoded).collect()] == [9]


def test_numbers_count_in_any_spelling_and_size(frame):
    url = "GET /a/b.m3u8 HTTP/1.1"
    records = [
        _request(url, body_bytes_sent=250.0), _request(url, body_bytes_sent="250"),
        _request(url, body_bytes_sent=2**62), _request(url, http_stat="404"), _request(url, http_stat=200.0),
        _request(url, http_stat="gone"), _request(url, svr_type="1"), _request(url, svr_type="edge"),
        _request(url, request_time="1e3"), _request(url, request_time="1234567890123"),
        _request("GET /a[1]/b.m3u8 HTTP/1.1"),
    ]
    rows = _derive(frame, records)
    assert [rows[i]["flux"] for i in (0, 1, 2)] == [250, 250, 2**62]
    assert [rows[i]["http_stat"] for i in (3, 4, 5)] == [404, 200, 0]
    assert [rows[i]["svr_type"] for i in (6, 7)] == [1, -1]
    assert [rows[i]["request_time"] for i in (8, 9)] == [10**6, 1234567890123000]
    assert rows[10]["app"] == "a[1]"
    sums = base(hls.requests(frame(HLS_TOPIC, [records[2]] * 5)), "hls")
    assert sums.first()["flux"] == 5 * 2**62
    assert base(sums, "hls").first()["flux"] == 5 * 2**62


def test_unknown_compare_mode(frame):
    with pytest.raises(ValueError):
        hls.requests(frame(HLS_TOPIC, []), slice_compare="other")


def test_parse_happens_once_and_only_used_columns_shuffle(frame):
    sums = base(hls.requests(frame(HLS_TOPIC, [SEGMENT])), "hls")
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.count("Exchange") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "remote_addr#" not in plan.split("Exchange")[0]
    assert sums.filter(F.col("counts") > 0).count() == 1


def test_a_status_beyond_int_is_not_valid(frame):
    row = _derive(frame, [_request("GET /a/b.m3u8 H", http_stat=3_000_000_000)])[0]
    assert (row["http_stat"], row["valid"], row["nlt_400_counts"], row["flux"]) == (2**31 - 1, False, 1, 0)
