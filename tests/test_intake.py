import json

import pytest
from pyspark.sql import functions as F

from flowtally.operators import hls, rtmp
from flowtally.plans.base import base, fold
from flowtally.schemas import FRAME, HLS_TOPIC, RTMP_TOPIC
from flowtally.sources import archive, sealed
from flowtally.streaming import intake, ledger, partials, served
from samples import PLAYLIST, SEGMENT, SESSION

DAY, LATE_DAY = 20231115, 20140514
LATE = {**SEGMENT, "unix_time": "1400000000"}


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _messages(spark, records):
    """(topic, partition, offset, record) -> common frame."""
    rows = [(t, r if isinstance(r, str) else json.dumps(r), t, p, o, None) for t, p, o, r in records]
    return spark.createDataFrame(rows, FRAME)


def test_sealed_days_come_in_order(spark, folder):
    batches = [[(HLS_TOPIC, 1, 9, SEGMENT), (HLS_TOPIC, 0, 3, LATE), (HLS_TOPIC, 0, 4, SEGMENT), (RTMP_TOPIC, 0, 1, SESSION)],
               [(HLS_TOPIC, 1, 2, PLAYLIST), (HLS_TOPIC, 0, 1, SEGMENT), (HLS_TOPIC, 0, 0, "junk")],
               [(HLS_TOPIC, 0, 2, SEGMENT)]]
    for batch_id, records in enumerate(batches):
        for _ in range(2):
            sealed.keep(_messages(spark, records), folder("a"), "first", batch_id)
    before = _rows(sealed.replay(spark, folder("a"), HLS_TOPIC, DAY))
    assert sealed.seal(spark, folder("a"), HLS_TOPIC, DAY) == 7
    assert sealed.seal(spark, folder("a"), HLS_TOPIC, DAY) is None
    got = sealed.replay(spark, folder("a"), HLS_TOPIC, DAY).collect()
    assert [(r["partition"], r["offset"]) for r in got] == [(0, 1), (0, 2), (0, 4), (1, 2), (1, 9)]
    assert _rows(sealed.replay(spark, folder("a"), HLS_TOPIC, DAY)) == before and json.loads(got[0]["value"]) == SEGMENT
    parts = ledger.Ledger(spark, folder("a")).state()[1]
    assert [p["run"] for p in ledger.of_table(parts, "lines", topic=HLS_TOPIC, day=DAY)] == [ledger.MERGED]
    assert sealed.replay(spark, folder("a"), HLS_TOPIC, LATE_DAY).count() == 1
    assert sealed.replay(spark, folder("a"), RTMP_TOPIC, LATE_DAY).count() == 0
    # A sealed batch that is written anew gives back what it held.
    sealed.keep(_messages(spark, [(HLS_TOPIC, 0, 7, SEGMENT)]), folder("a"), "first", 0)
    got = sealed.replay(spark, folder("a"), HLS_TOPIC, DAY).collect()
    assert [(r["partition"], r["offset"]) for r in got] == [(0, 1), (0, 2), (0, 7), (1, 2)]
    assert sealed.seal(spark, folder("a"), HLS_TOPIC, DAY)


def test_a_sealed_file_is_sorted(spark, folder):
    records = [(HLS_TOPIC, i % 3, 1000 - i, SEGMENT) for i in range(300)]
    sealed.keep(_messages(spark, records[:100]), folder("a"), "first", 0)
    sealed.keep(_messages(spark, records[100:]), folder("a"), "first", 1)
    sealed.seal(spark, folder("a"), HLS_TOPIC, DAY)
    part, = ledger.of_table(ledger.Ledger(spark, folder("a")).state()[1], "lines")
    for file in spark.read.parquet(f"{folder('a')}/{part['folder']}").inputFiles():
        places = [(r["partition"], r["offset"]) for r in spark.read.parquet(file).collect()]
        assert places == sorted(places)


def test_progress_opens_the_files_around_the_offsets(spark, folder):
    for batch_id in range(6):
        records = [(HLS_TOPIC, p, 100 * batch_id + 10 * i, LATE if batch_id == 2 else SEGMENT) for p in (0, 1) for i in range(10)]
        sealed.keep(_messages(spark, records), folder("a"), "first", batch_id)
    offsets = spark.createDataFrame([(0, 205), (1, 195), (2, 7)], "partition int, offset bigint")
    files = sealed.files_at(spark, folder("a"), HLS_TOPIC, offsets)
    zones = ledger.of_table(ledger.Ledger(spark, folder("a")).state()[1], "lines")
    assert len(files) == 1 and len(zones) == 6
    got = sorted(map(tuple, sealed.reached_day(spark, folder("a"), HLS_TOPIC, offsets).collect()))
    assert got == [(0, 205, 210, LATE_DAY), (1, 195, 200, LATE_DAY)]
    last = spark.createDataFrame([(0, 10_000)], "partition int, offset bigint")
    assert sealed.files_at(spark, folder("a"), HLS_TOPIC, last) == []
    assert sealed.reached_day(spark, folder("a"), HLS_TOPIC, last).count() == 0


def _batch(spark):
    return _messages(spark, [(HLS_TOPIC, 0, 0, SEGMENT), (HLS_TOPIC, 0, 1, LATE), (RTMP_TOPIC, 0, 0, SESSION),
                             (HLS_TOPIC, 0, 2, "junk"), (RTMP_TOPIC, 0, 1, "{}")])


def _seen(spark, root):
    counted = [partials.read_partials(spark, root, feed, table=intake.sums_table(feed)).count() for feed in ("hls", "rtmp")]
    lines = sum(sealed.replay(spark, root, HLS_TOPIC, day).count() for day in (DAY, LATE_DAY))
    return [*counted, lines, intake.read_rejects(spark, root).count()]


@pytest.mark.parametrize("writes", range(1, 5))
def test_a_stop_between_any_two_writes_leaves_nothing(spark, folder, monkeypatch, writes):
    plain, done = ledger.Ledger.write, []

    def stops(self, *args, **kwargs):
        if len(done) == writes:
            raise ZeroDivisionError
        done.append(1)
        return plain(self, *args, **kwargs)

    monkeypatch.setattr(ledger.Ledger, "write", stops)
    with pytest.raises(ZeroDivisionError):
        intake.account_both(_batch(spark), 0, folder("r"), "first")
    monkeypatch.undo()
    assert _seen(spark, folder("r")) == [0, 0, 0, 0]


def test_both_feeds_by_one_commit(spark, folder):
    for _ in range(2):
        intake.account_both(_batch(spark), 0, folder("r"), "first")
    # The second report has no fields; the archive cannot place the junk.
    assert _seen(spark, folder("r")) == [2, 1, 2, 3]
    for feed, operator in (("hls", hls.requests), ("rtmp", rtmp.sessions)):
        got = partials.read_partials(spark, folder("r"), feed, table=intake.sums_table(feed))
        assert _rows(fold(got, feed)) == _rows(base(operator(_batch(spark)), feed))
    served.fold(spark, "hls", folder("r"), folder("s"), table=intake.sums_table("hls"))
    assert served.table(spark, folder("s"), "hls_down").count() == 2
    intake.account_both(_messages(spark, [(RTMP_TOPIC, 0, 5, SESSION)]), 0, folder("r"), "first")
    assert _seen(spark, folder("r")) == [0, 1, 0, 0]
    served.fold(spark, "hls", folder("r"), folder("s"), table=intake.sums_table("hls"))
    assert served.table(spark, folder("s"), "hls_down").count() == 0


def test_messages_of_a_feed_are_decoded_once(spark, folder, monkeypatch):
    plain, seen = hls.read, spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(malformed):
        seen.add(1)
        return malformed

    monkeypatch.setattr(hls, "read", lambda batch: plain(batch).withColumn("malformed", counted("malformed")))
    intake.account_both(_batch(spark), 0, folder("r"), "first")
    assert seen.value == 3 and _seen(spark, folder("r")) == [2, 1, 2, 3]


def test_one_query_reads_the_source_once(spark, folder, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(2):
        lines = [json.dumps({"key": t, "topic": t, "partition": 0, "offset": 10 * i + k, "value": json.dumps(r)})
                 for k, (t, r) in enumerate([(HLS_TOPIC, SEGMENT), (RTMP_TOPIC, SESSION)])]
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(lines))
    stream = spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = intake.start(stream, folder("r"), folder("c"), "first", availableNow=True)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [2, 2]
    assert _seen(spark, folder("r"))[:3] == [2, 2, 2] and ledger.Ledger(spark, folder("r")).version() == 2


def _pages(spark, partition, first, n, size=4):
    rows = []
    for at in range(first, first + n * size, size):
        page = {"nextOffset": at + size, "list": [{"body": f"m{partition}-{o}", "offset": o} for o in range(at, at + size)]}
        rows.append((partition, json.dumps(page)))
    return spark.createDataFrame(rows, "partition int, value string")


def _offsets(spark, rows):
    return spark.createDataFrame(rows, "partition int, startOffset bigint, offset bigint")


def test_pulls_neither_lose_nor_repeat(spark, folder, monkeypatch):
    pages = _pages(spark, 0, 0, 6).unionByName(_pages(spark, 1, 100, 3)).unionByName(_pages(spark, 0, 8, 1))
    offsets = _offsets(spark, [(0, 5, 2), (1, 0, 104), (2, 0, 0)])

    def got():
        return sorted((r["partition"], r["offset"]) for r in intake.pulled(spark, folder("r")).collect())

    assert intake.pull(pages, offsets, folder("r"), "first", limit=8) == 2
    assert intake.positions(spark, folder("r")) == {0: 12, 1: 112}
    assert got() == [(0, o) for o in range(5, 12)] + [(1, o) for o in range(104, 112)]
    with monkeypatch.context() as stopped:
        stopped.setattr(ledger.Ledger, "commit", lambda self, kind, change: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            intake.pull(pages, offsets, folder("r"), "first", limit=8)
    assert intake.positions(spark, folder("r")) == {0: 12, 1: 112}
    while intake.pull(pages, offsets, folder("r"), "first", limit=3):
        pass
    assert got() == [(0, o) for o in range(5, 24)] + [(1, o) for o in range(104, 112)]
    bodies = {(r["partition"], r["offset"]): r["body"] for r in intake.pulled(spark, folder("r")).collect()}
    assert bodies[0, 23] == "m0-23"
    # The queue dropped messages: the position is moved up to the first one kept.
    assert intake.pull(_pages(spark, 0, 24, 4), _offsets(spark, [(0, 30, 0)]), folder("r"), "first", limit=100) == 1
    assert got()[-9] == (0, 39) and (0, 29) not in got() and (0, 30) in got()


def test_positioned_lines_have_the_day_of_the_archive(spark):
    frame = _batch(spark)
    lines = archive.positioned_lines(frame).select("topic", "partition", "offset", "day")
    want = archive.with_event_day(frame).where("day is not null").select("topic", "partition", "offset", "day")
    assert _rows(lines) == _rows(want) and lines.where(F.col("day") == LATE_DAY).count() == 1
