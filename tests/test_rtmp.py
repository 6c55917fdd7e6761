from flowtally.operators import rtmp
from flowtally.plans.base import base, shown
from flowtally.schemas import RTMP_DIMS, RTMP_METRICS, RTMP_TOPIC
from samples import SESSION


def test_golden_row(frame):
    row = shown(base(rtmp.sessions(frame(RTMP_TOPIC, [SESSION])), "rtmp")).collect()[0]
    assert [row[c] for c in RTMP_DIMS] == [
        "play", 2023111509, "reef", "north", "-1", "192.0.2.99"]
    assert {m: row[m] for m in RTMP_METRICS} == {
        "valid_counts": 1, "total_counts": 1, "play_fluency": 98.0, "play_fluency_in60s": 97.0,
        "publish_time": 181000, "play_fluency_time": 17738000.0, "empty_numbers": 2,
        "empty_time": 350, "max_empty_time": 200, "first_buffer_time": 75, "empty_numbers_in60s": 1,
        "empty_time_in60s": 120, "play_fluency_zero_counts": 0, "max60s_fluency": 99.0,
        "min60s_fluency": 97.25, "flux": 271828180,
    }


def test_derivations(frame):
    cases = [
        ({"Cmd": "publish", "RecvByteSum": 5}, {"flux": 5}),
        ({"Cmd": "forward", "RecvByteSum": 6}, {"flux": 6}),
        ({"PublishTime": 29999}, {"valid_counts": 0}),
        ({"PublishTime": 30000}, {"valid_counts": 1}),
        ({"PlayFluency": 0}, {"play_fluency_zero_counts": 1, "play_fluency_time": 0.0}),
        ({"User": "42"}, {"user": "42"}),
        ({"User": 42}, {"user": "42"}),
        ({"EndTime": "1700010000"}, {"timestamp_hour": 2023111509}),
        ({"PlayFluency": 200 / 3, "PlayTime": 3}, {"play_fluency": 66.666666666667,
                                                   "play_fluency_time": 200.000000000001}),
        ({"PlayFluency": 1e-05}, {"play_fluency": 0.00001}),
    ]
    records = [{**SESSION, **changes} for changes, _ in cases]
    derived = shown(rtmp.derive(rtmp.accept(rtmp.read(frame(RTMP_TOPIC, records)))))
    rows = {r["offset"]: r for r in derived.collect()}
    for i, (changes, expected) in enumerate(cases):
        assert {k: rows[i][k] for k in expected} == expected, changes


def test_missing_end_time_and_unused_byte_sum(frame):
    record = {k: v for k, v in SESSION.items() if k not in ("EndTime", "RecvByteSum")}
    row = rtmp.sessions(frame(RTMP_TOPIC, [record])).collect()[0]
    assert row["timestamp_hour"] == 1970010108 and row["flux"] == SESSION["SendByteSum"]


def test_rejects(frame):
    def without(name):
        return {k: v for k, v in SESSION.items() if k != name}
    records = [
        SESSION, without("Cmd"), without("SendByteSum"), without("Min60sFluency"),
        {**SESSION, "EndTime": "soon"}, {**SESSION, "PlayFluency": "fine"}, "{", {},
        {**SESSION, "PublishTime": "x"}, {**SESSION, "EmptyTime": 10**20},
    ]
    decoded = rtmp.read(frame(RTMP_TOPIC, records))
    assert {r["offset"]: r["reject"] for r in rtmp.rejects(decoded).collect()} == {
        1: "missing_field", 2: "missing_field", 3: "missing_field", 4: "bad_end_time",
        5: "bad_metric", 6: "malformed_json", 7: "missing_field", 8: "bad_metric",
        9: "bad_metric",
    }
    assert [r["offset"] for r in rtmp.accept(decoded).collect()] == [0]


def test_large_and_differently_spelt_values_count(frame):
    records = [
        {**SESSION, "SendByteSum": 12 * 10**11}, {**SESSION, "PlayFluency": 1_000_000, "PlayTime": "164089.0"},
        {**SESSION, "PublishTime": 164089.0, "EmptyTime": "35"}, {**SESSION, "SendByteSum": 2**62},
        {**SESSION, "SendByteSum": 2**62}, {**SESSION, "Min60sFluency": "97.25"},
    ]
    rows = rtmp.derive(rtmp.accept(rtmp.read(frame(RTMP_TOPIC, records)))).orderBy("offset").collect()
    assert [r["flux"] for r in rows[:1]] == [12 * 10**11] and len(rows) == 6
    assert float(rows[1]["play_fluency_time"]) == 164089 * 10**6
    assert (rows[2]["publish_time"], rows[2]["empty_time"]) == (164089, 35)
    total = base(rtmp.sessions(frame(RTMP_TOPIC, records)), "rtmp").agg({"flux": "sum"}).first()[0]
    assert total == 12 * 10**11 + 2 * 2**62 + 3 * SESSION["SendByteSum"]


def test_fractions_add_up_exactly(frame):
    records = [{**SESSION, "Min60sFluency": 0.1}] * 10
    row = shown(base(rtmp.sessions(frame(RTMP_TOPIC, records)), "rtmp")).collect()[0]
    assert row["min60s_fluency"] == 1.0
