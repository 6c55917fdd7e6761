import pytest
from pyspark.sql import functions as F

from flowtally.plans import rollups
from flowtally.plans.base import COUNTERS, KEYS, base, fold
from flowtally.operators import hls, rtmp
from flowtally.schemas import HLS_TOPIC, RTMP_TOPIC
from flowtally.streaming import ledger, partials, served
from samples import PLAYLIST, SEGMENT, SESSION

LATE = {**SEGMENT, "unix_time": "1400000000"}
DAY, LATE_DAY = 20231115, 20140514


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _account(frame, folder, batch_id, records, feed="hls", run="first"):
    topic = {"hls": HLS_TOPIC, "rtmp": RTMP_TOPIC}[feed]
    partials.account_batch(frame(topic, records), batch_id, feed, folder("p"), run)


def _fold(spark, folder, feed="hls"):
    return served.fold(spark, feed, folder("p"), folder("s"))


def _same_as_rebuilt(spark, folder, feed="hls"):
    """Every served table equals one computed from all partial sums."""
    sums = partials.read_partials(spark, folder("p"), feed)
    found = {}
    for name in ("hls_down", "hls_down_user_hour", "hls_stream_data") if feed == "hls" else ("rtmp_down", "rtmp_up_user_hour"):
        found[name] = _rows(served.table(spark, folder("s"), name))
        assert found[name] == _rows(rollups.rollup(sums, name)), name
    return found


def test_versions_and_writers_that_meet(spark, folder):
    log, other = ledger.Ledger(spark, folder("t")), ledger.Ledger(spark, folder("t"))
    assert log.state() == (0, {}, {})
    part = {"table": "x", "run": "r", "batch_id": 0, "folder": "f", "keys": {}}
    asked = []

    def slow(parts, note):
        asked.append(len(parts))
        if len(asked) == 1:
            assert other.commit("batch", lambda p, n: ([{**part, "id": "other"}], [], {})) == 1
        return [{**part, "id": "mine"}], [], {"seen": len(parts)}

    assert log.commit("batch", slow) == 2 and asked == [0, 1]
    assert set(log.state()[1]) == {"other", "mine"} and log.state()[2] == {"seen": 1}
    assert set(log.state(1)[1]) == {"other"}
    assert log.commit("none", lambda p, n: None) is None and log.version() == 2


def test_states_stand_for_older_commits(spark, folder, monkeypatch):
    monkeypatch.setattr(ledger, "STATE_EVERY", 3)
    log = ledger.Ledger(spark, folder("t"))
    for i in range(7):
        part = {"id": str(i), "table": "x", "run": "r", "batch_id": i, "folder": "f", "keys": {}}
        log.commit("batch", lambda p, n: ([part], [str(i - 2)], {"last": i}))
    opened = []
    read = log._read
    monkeypatch.setattr(log, "_read", lambda *names: opened.append(names[0]) or read(*names))
    assert set(log.state()[1]) == {"5", "6"} and opened == ["states", "log"]
    assert set(log.state(4)[1]) == {"2", "3"} and log.state(4)[2] == {"last": 3}


def test_a_part_without_its_commit_is_not_seen(spark, frame, folder, monkeypatch):
    _account(frame, folder, 0, [SEGMENT])
    monkeypatch.setattr(ledger.Ledger, "commit", lambda self, kind, change: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _account(frame, folder, 1, [SEGMENT])
    assert partials.read_partials(spark, folder("p"), "hls").agg(F.sum("counts")).first()[0] == 1
    monkeypatch.undo()
    _account(frame, folder, 1, [SEGMENT])
    assert partials.read_partials(spark, folder("p"), "hls").agg(F.sum("counts")).first()[0] == 2


def test_days_that_a_new_attempt_no_longer_meets_go(spark, frame, folder):
    _account(frame, folder, 0, [SEGMENT, LATE])
    _fold(spark, folder)
    assert len(_same_as_rebuilt(spark, folder)["hls_down"]) == 2
    _account(frame, folder, 0, [PLAYLIST])
    _fold(spark, folder)
    assert len(_same_as_rebuilt(spark, folder)["hls_down"]) == 1
    _account(frame, folder, 0, [])
    _fold(spark, folder)
    assert _same_as_rebuilt(spark, folder) == {"hls_down": [], "hls_down_user_hour": [], "hls_stream_data": []}


@pytest.mark.parametrize("feed, record", [("hls", SEGMENT), ("rtmp", SESSION)])
def test_deltas_equal_a_rebuild(spark, frame, folder, feed, record):
    time = "unix_time" if feed == "hls" else "EndTime"
    old = {**record, time: "1400000000" if feed == "hls" else 1400000000}
    next_hour = {**old, time: "1400003600" if feed == "hls" else 1400003600}
    for step in (
        lambda: _account(frame, folder, 0, [record, old], feed),
        lambda: _account(frame, folder, 1, [old, next_hour, record, record], feed),
        lambda: _account(frame, folder, 1, [next_hour], feed),
        lambda: partials.compact(spark, feed, folder("p"), [LATE_DAY, DAY]),
        lambda: _account(frame, folder, 0, [old, old], feed),
        lambda: partials.purge(spark, folder("p"), LATE_DAY),
        lambda: _account(frame, folder, 2, [old], feed, run="again"),
    ):
        step()
        _fold(spark, folder, feed)
        _same_as_rebuilt(spark, folder, feed)
    served.refresh(spark, feed, folder("p"), folder("s"))
    assert _same_as_rebuilt(spark, folder, feed)


def test_a_fold_reads_new_batches_and_touched_days_only(spark, frame, folder, monkeypatch):
    for batch_id in range(3):
        _account(frame, folder, batch_id, [SEGMENT, {**SEGMENT, "unix_time": str(1400000000 + 3600 * batch_id)}])
        _fold(spark, folder)
    _account(frame, folder, 3, [{**SEGMENT, "unix_time": "1500000000"}])
    _fold(spark, folder)
    _account(frame, folder, 1, [{**SEGMENT, "unix_time": "1400003600"}])
    read, plain = [], ledger.Ledger.read

    def watched(self, parts, table, schema):
        rows = plain(self, parts, table, schema)
        read.extend((table, part["run"], part["batch_id"], part["keys"]["day"]) for part in parts)
        assert len(rows.inputFiles()) == sum(part["files"] for part in parts)
        return rows

    monkeypatch.setattr(ledger.Ledger, "read", watched)
    _fold(spark, folder)
    assert {x[1:3] for x in read if x[0] == "sums"} == {("first", 1)}
    assert sorted(x[3] for x in read if x[0] == "hours") == [str(LATE_DAY), str(DAY)]
    read.clear()
    _fold(spark, folder)
    assert not read
    monkeypatch.undo()
    _same_as_rebuilt(spark, folder)


def test_a_fold_stopped_before_its_commit_is_repeated(spark, frame, folder, monkeypatch):
    _account(frame, folder, 0, [SEGMENT, LATE])
    plain = ledger.Ledger.commit
    monkeypatch.setattr(ledger.Ledger, "commit", lambda self, kind, change: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        _fold(spark, folder)
    assert served.table(spark, folder("s"), "hls_down").count() == 0
    monkeypatch.setattr(ledger.Ledger, "commit", plain)

    def overtaken(self, kind, change):
        if kind == "fold":
            monkeypatch.setattr(ledger.Ledger, "commit", plain)
            _fold(spark, folder)
        return plain(self, kind, change)

    monkeypatch.setattr(ledger.Ledger, "commit", overtaken)
    _fold(spark, folder)
    _same_as_rebuilt(spark, folder)


def test_compaction(spark, frame, folder, monkeypatch):
    def sums():
        return _rows(fold(partials.read_partials(spark, folder("p"), "hls"), "hls"))

    for batch_id in range(3):
        _account(frame, folder, batch_id, [SEGMENT, LATE, PLAYLIST])
    assert partials.scattered_days(spark, folder("p"), DAY) == [LATE_DAY]
    before = sums()
    with monkeypatch.context() as stopped:
        stopped.setattr(ledger.Ledger, "commit", lambda self, kind, change: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            partials.compact(spark, "hls", folder("p"), [LATE_DAY])
    assert sums() == before
    assert partials.compact(spark, "hls", folder("p"), [LATE_DAY]) == 4
    assert sums() == before and partials.scattered_days(spark, folder("p"), DAY) == []
    parts = ledger.of_table(ledger.Ledger(spark, folder("p")).state()[1], "sums", day=LATE_DAY)
    assert [part["run"] for part in parts] == [ledger.MERGED]
    # A reader that had begun keeps the old parts.
    assert _rows(fold(partials.read_partials(spark, folder("p"), "hls", version=3), "hls")) == before
    _account(frame, folder, 3, [LATE])
    assert partials.read_partials(spark, folder("p"), "hls", days=[LATE_DAY]).agg(F.sum("counts")).first()[0] == 4
    assert partials.compact(spark, "hls", folder("p"), [LATE_DAY]) and partials.compact(spark, "hls", folder("p"), [1]) is None
    _account(frame, folder, 1, [SEGMENT])
    left = partials.read_partials(spark, folder("p"), "hls").groupBy("day").agg(F.sum("counts")).collect()
    assert sorted(map(tuple, left)) == [(LATE_DAY, 3), (DAY, 5)]


def test_compaction_gives_way_to_a_new_attempt(spark, frame, folder, monkeypatch):
    for batch_id in range(2):
        _account(frame, folder, batch_id, [LATE])
    plain = ledger.Ledger.write

    def write(self, *args):
        parts = plain(self, *args)
        monkeypatch.setattr(ledger.Ledger, "write", plain)
        _account(frame, folder, 1, [LATE, LATE])
        return parts

    monkeypatch.setattr(ledger.Ledger, "write", write)
    assert partials.compact(spark, "hls", folder("p"), [LATE_DAY]) is None
    assert partials.read_partials(spark, folder("p"), "hls").agg(F.sum("counts")).first()[0] == 3


def test_purge_is_one_commit_and_later_batches_count(spark, frame, folder, monkeypatch):
    for batch_id in range(3):
        _account(frame, folder, batch_id, [LATE, SEGMENT])
    version = ledger.Ledger(spark, folder("p")).version()
    monkeypatch.setattr(ledger.Ledger, "write", None)
    assert partials.purge(spark, folder("p"), LATE_DAY) == version + 1
    monkeypatch.undo()
    assert partials.read_partials(spark, folder("p"), "hls", days=[LATE_DAY]).count() == 0
    _account(frame, folder, 0, [LATE], run="second")
    assert partials.read_partials(spark, folder("p"), "hls", days=[LATE_DAY]).agg(F.sum("counts")).first()[0] == 1


def test_hour_levels_are_the_tables(frame):
    for feed, operator, topic, records in (("hls", hls.requests, HLS_TOPIC, [SEGMENT, PLAYLIST, {**SEGMENT, "svr_type": 2}]),
                                           ("rtmp", rtmp.sessions, RTMP_TOPIC, [SESSION])):
        rows = operator(frame(topic, records))
        kept = rollups.hour_levels(base(rows, feed), feed)
        assert set(rollups.hour_counts(feed)["sums"]) < set(kept.columns) and KEYS[feed] and COUNTERS[feed]
        for name, spec in rollups.CATALOGUE.items():
            if spec.feed == feed:
                assert _rows(rollups.serve_hours(kept, name)) == _rows(rollups.rollup(rows, name)), name


def test_rows_are_added_to_kept_ones_only_where_there_are_some(spark, frame, folder, monkeypatch):
    plain, sums = ledger.Ledger.write, []

    def noted(self, rows, table, *args, **kwargs):
        if table == served.HOURS:
            sums.append(rows._jdf.queryExecution().optimizedPlan().toString().count("Aggregate ["))
        return plain(self, rows, table, *args, **kwargs)

    monkeypatch.setattr(ledger.Ledger, "write", noted)
    _account(frame, folder, 0, [SEGMENT, PLAYLIST, LATE])
    _fold(spark, folder)
    _same_as_rebuilt(spark, folder)
    _account(frame, folder, 1, [SEGMENT])
    _fold(spark, folder)
    _same_as_rebuilt(spark, folder)
    served.refresh(spark, "hls", folder("p"), folder("s"))
    _same_as_rebuilt(spark, folder)
    assert sums == [1, 2, 1]
