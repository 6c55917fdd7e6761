"""Every registered query: (session, data folder) -> DataFrame over whole tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowtally_checks import feeds
from flowtally.functions import timekeys
from flowtally.operators import decode, geo, hls, progress, rtmp
from flowtally.plans import base, cascade, rollups, upkeep
from flowtally.schemas import HLS_DIMS, HLS_METRICS, HLS_TOPIC, RTMP_DIMS, RTMP_METRICS, RTMP_TOPIC
from flowtally.session import work_dir
from flowtally.sources import archive, handoff, mq, sealed
from flowtally.streaming import intake, ledger, partials, served

# A local day that lies inside the data at every scale.
DAY = 20240115


def _mixed(spark, sf_dir):
    return feeds.mixed_messages(feeds.events(spark, sf_dir))


def _requests(spark, sf_dir):
    return hls.requests(_mixed(spark, sf_dir))


def _sessions(spark, sf_dir):
    return rtmp.sessions(_mixed(spark, sf_dir))


def _derived(spark, sf_dir):
    return hls.derive(hls.accept(hls.read(_mixed(spark, sf_dir))))


# --- sources and sinks ------------------------------------------------------


def route_topics(spark, sf_dir):
    frame = _mixed(spark, sf_dir)
    routed = [decode.route(frame, topic) for topic in (HLS_TOPIC, RTMP_TOPIC)]
    return routed[0].unionByName(routed[1]).groupBy("topic", "partition").agg(
        F.count("*").alias("n_messages"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"))


def json_quarantine(spark, sf_dir):
    decoded = hls.read(feeds.damaged_messages(feeds.events(spark, sf_dir)))
    good = hls.accept(decoded).select("offset", F.lit("accepted").alias("verdict"))
    return good.unionByName(hls.rejects(decoded).select("offset", F.col("reject").alias("verdict")))


def mq_explode(spark, sf_dir):
    return mq.explode_pages(feeds.mq_pages(feeds.events(spark, sf_dir)))


def mq_normalise(spark, sf_dir):
    normalised = mq.normalise(mq_explode(spark, sf_dir))
    return normalised.select(
        "partition", "offset", "value",
        F.get_json_object("value", "$.k").cast("bigint").alias("k"),
        F.when(F.col("value").isNull(), "malformed_json").alias("reject"))


def _archive(spark, sf_dir):
    path = work_dir(spark, "archive")
    archive.write(_mixed(spark, sf_dir), path)
    return path


def archive_by_day(spark, sf_dir):
    lines = archive.read(spark, _archive(spark, sf_dir))
    return lines.groupBy("topic", F.col("day").cast("bigint").alias("day")).agg(
        F.count("*").alias("n_messages"))


def replay_day(spark, sf_dir):
    frame = archive.replay(spark, _archive(spark, sf_dir), HLS_TOPIC, DAY)
    # The replayed lines arrive encoded once more, as the old replay tool sent them.
    encoded = frame.withColumn("value", F.regexp_extract(
        F.to_json(F.array("value")), r"^\[(.*)\]$", 1))
    return base.shown(base.base(hls.requests(decode.unwrap_double_encoded(encoded)), "hls"))


def _stream_partials(spark, sf_dir, feed):
    messages = feeds.mixed_messages(feeds.event_stream(spark, sf_dir))
    folder = work_dir(spark, f"stream-{feed}")
    query = partials.start_partials(
        messages, feed, f"{folder}/partials", f"{folder}/checkpoint", "first",
        rejects_path=f"{folder}/rejects", availableNow=True)
    query.awaitTermination()
    return base.shown(base.fold(partials.read_partials(spark, f"{folder}/partials", feed), feed))


def stream_hls_partials(spark, sf_dir):
    return _stream_partials(spark, sf_dir, "hls")


def stream_rtmp_partials(spark, sf_dir):
    return _stream_partials(spark, sf_dir, "rtmp")


def _handoff(counters, feed, name):
    """A served table from partial sums that went through JSON records."""
    good, _ = handoff.read(handoff.encode(base.base(counters, feed), feed), feed)
    return rollups.rollup(good, name)


def handoff_hls(spark, sf_dir):
    return _handoff(_requests(spark, sf_dir), "hls", "hls_down_a")


def handoff_rtmp(spark, sf_dir):
    return _handoff(_sessions(spark, sf_dir), "rtmp", "rtmp_down")


def _fold(spark, sf_dir, feed):
    """Sums of the first queue partition, increased by those of the others."""
    operators = {"hls": hls, "rtmp": rtmp}[feed]
    rows = operators.derive(operators.accept(operators.read(_mixed(spark, sf_dir))))
    sums = base.base(rows, feed, "partition")
    first = sums.filter("partition = 0").drop("partition")
    others = sums.filter("partition > 0").drop("partition")
    return base.shown(base.increment_or_insert(first, others, base.KEYS[feed]))


def fold_hls(spark, sf_dir):
    return _fold(spark, sf_dir, "hls")


def fold_rtmp(spark, sf_dir):
    return _fold(spark, sf_dir, "rtmp")


# --- values, retries and serving --------------------------------------------


def hls_wide_values(spark, sf_dir):
    """Byte counts of terabytes, numbers as text or with a fraction, times with an exponent."""
    messages = feeds.wide_hls_messages(feeds.events(spark, sf_dir))
    return rollups.rollup(hls.requests(messages), "hls_down_a", base.shown_whole)


def rtmp_wide_values(spark, sf_dir):
    messages = feeds.wide_rtmp_messages(feeds.events(spark, sf_dir))
    return rollups.rollup(rtmp.sessions(messages), "rtmp_down_app", base.shown_whole)


def json_quarantine_rtmp(spark, sf_dir):
    decoded = rtmp.read(feeds.damaged_reports(feeds.events(spark, sf_dir)))
    good = rtmp.accept(decoded).select("offset", F.lit("accepted").alias("verdict"))
    return good.unionByName(rtmp.rejects(decoded).select("offset", F.col("reject").alias("verdict")))


def _archive_stream(spark, sf_dir):
    folder = work_dir(spark, "archive-stream")
    archive.write_stream(
        feeds.mixed_messages(feeds.event_stream(spark, sf_dir)), f"{folder}/archive", f"{folder}/checkpoint",
        "first", f"{folder}/rejects", availableNow=True).awaitTermination()
    return f"{folder}/archive"


def archive_stream_by_day(spark, sf_dir):
    lines = archive.read(spark, _archive_stream(spark, sf_dir))
    return lines.groupBy("topic", F.col("day").cast("bigint").alias("day")).agg(
        F.count("*").alias("n_messages"))


def replay_streamed_day(spark, sf_dir):
    frame = archive.replay(spark, _archive_stream(spark, sf_dir), HLS_TOPIC, DAY)
    return base.shown(base.base(hls.requests(frame), "hls"))


def _two_batches(spark, sf_dir, feed, path):
    """Partial sums of all events in two batches; the first attempt at the second had other input."""
    messages = _mixed(spark, sf_dir)
    even, odd = messages.where("offset % 2 = 0"), messages.where("offset % 2 = 1")
    partials.account_batch(even, 0, feed, path, "first")
    yield
    partials.account_batch(messages, 1, feed, path, "first")
    partials.account_batch(odd, 1, feed, path, "first")
    yield


def stream_rewritten_batch(spark, sf_dir):
    path = f"{work_dir(spark, 'rewritten')}/partials"
    for _ in _two_batches(spark, sf_dir, "hls", path):
        pass
    return base.shown(base.fold(partials.read_partials(spark, path, "hls"), "hls"))


def _serve(spark, sf_dir, feed, name):
    """A served table kept up by a job that is started anew after each batch."""
    folder = work_dir(spark, f"serve-{feed}")
    for _ in _two_batches(spark, sf_dir, feed, f"{folder}/partials"):
        served.follow(spark, feed, f"{folder}/partials", f"{folder}/rollups", f"{folder}/checkpoint",
                      availableNow=True).awaitTermination()
    return served.table(spark, f"{folder}/rollups", name)


def serve_hls(spark, sf_dir):
    return _serve(spark, sf_dir, "hls", "hls_down_app_stream")


def serve_rtmp(spark, sf_dir):
    return _serve(spark, sf_dir, "rtmp", "rtmp_down_app")


def _rewritten(spark, sf_dir, feed, name):
    """A served table after a batch, folded already, was written again with fewer messages and days."""
    folder = work_dir(spark, f"rewritten-{feed}")
    path, messages = f"{folder}/partials", _mixed(spark, sf_dir)
    even, odd = messages.where("offset % 2 = 0"), messages.where("offset % 2 = 1")
    for batch_id, batch in ((0, even), (1, messages), (1, odd)):
        partials.account_batch(batch, batch_id, feed, path, "first")
        served.follow(spark, feed, path, f"{folder}/rollups", f"{folder}/checkpoint",
                      availableNow=True).awaitTermination()
    return served.table(spark, f"{folder}/rollups", name)


def serve_rewritten_batch_hls(spark, sf_dir):
    return _rewritten(spark, sf_dir, "hls", "hls_down_a")


def serve_rewritten_batch_rtmp(spark, sf_dir):
    return _rewritten(spark, sf_dir, "rtmp", "rtmp_down")


def _compacted(spark, sf_dir):
    """Partial sums in three batches, merged by day after two and after all; the second is written anew in between."""
    path, messages = f"{work_dir(spark, 'compacted')}/partials", _mixed(spark, sf_dir)
    batches = [messages.where(f"offset % 3 = {i}") for i in range(3)]
    partials.account_batch(batches[0], 0, "hls", path, "first")
    partials.account_batch(messages, 1, "hls", path, "first")
    partials.compact(spark, "hls", path, partials.scattered_days(spark, path, DAY + 1))
    for batch_id in (1, 2):
        partials.account_batch(batches[batch_id], batch_id, "hls", path, "first")
    partials.compact(spark, "hls", path, partials.scattered_days(spark, path, DAY + 1))
    return path


def compacted_day(spark, sf_dir):
    """A day's base sums out of its merged part."""
    return base.shown(base.fold(partials.read_partials(spark, _compacted(spark, sf_dir), "hls", days=[DAY]), "hls"))


def serve_deltas(spark, sf_dir):
    """Hours kept up by deltas through a rewrite, merged days and a purged day."""
    folder, messages = work_dir(spark, "deltas"), _mixed(spark, sf_dir)
    path, kept = f"{folder}/partials", f"{folder}/rollups"
    for step in (
        lambda: partials.account_batch(messages.where("offset % 2 = 0"), 0, "hls", path, "first"),
        lambda: partials.account_batch(messages.where("offset % 5 = 0"), 1, "hls", path, "first"),
        lambda: partials.compact(spark, "hls", path, partials.scattered_days(spark, path, DAY + 1)),
        lambda: partials.account_batch(messages.where("offset % 2 = 1"), 1, "hls", path, "first"),
        lambda: served.purge_partials(spark, "hls", path, DAY),
    ):
        step()
        served.fold(spark, "hls", path, kept)
    return served.table(spark, kept, "hls_down_user_hour")


def _sealed(spark, sf_dir):
    """Archive of three batches, the last one written twice, with all closed days of the access log sealed."""
    path, messages = work_dir(spark, "sealed"), _mixed(spark, sf_dir)
    for batch_id in (0, 1, 2, 2):
        sealed.keep(messages.where(f"offset % 3 = {batch_id}"), path, "first", batch_id)
    for _ in range(2):
        sealed.seal(spark, path, HLS_TOPIC, DAY)
    return path


def replay_sealed_day(spark, sf_dir):
    """Lines of a sealed day by their place in the queue, with how much traffic each tells of."""
    frame = sealed.replay(spark, _sealed(spark, sf_dir), HLS_TOPIC, DAY)
    return frame.select("topic", "partition", "offset", F.get_json_object("value", "$.body_bytes_sent").cast("bigint").alias("bytes"))


def partition_progress_indexed(spark, sf_dir):
    """As partition_progress, from the archive's zones: only files around the offsets are opened."""
    rows, path = feeds.events(spark, sf_dir), work_dir(spark, "indexed")
    messages = feeds.hls_messages(rows).withColumn("partition", (F.col("offset") % 9).cast("int"))
    for batch_id in range(2):
        sealed.keep(messages.where(f"offset % 2 = {batch_id}"), path, "first", batch_id)
    sealed.seal(spark, path, HLS_TOPIC, DAY)
    return sealed.reached_day(spark, path, HLS_TOPIC, feeds.mq_offsets(rows))


def _intake(spark, sf_dir):
    """Both feeds in one pass."""
    root = work_dir(spark, "intake")
    intake.start(feeds.mixed_messages(feeds.event_stream(spark, sf_dir)), root, f"{root}-checkpoint", "first",
                 availableNow=True).awaitTermination()
    return root


def intake_both_feeds(spark, sf_dir):
    """Requests and sessions by feed and day, and archived lines, out of one pass."""
    root = _intake(spark, sf_dir)
    counted = [
        partials.read_partials(spark, root, feed, table=intake.sums_table(feed)).select(
            F.lit(feed).alias("name"), F.col("day").cast("bigint").alias("day"), F.col(count).alias("n"))
        for feed, count in (("hls", "counts"), ("rtmp", "total_counts"))]
    log = ledger.Ledger(spark, root)
    days = sorted({(part["keys"]["topic"], int(part["keys"]["day"])) for part in ledger.of_table(log.state()[1], sealed.LINES)})
    counted += [sealed.replay(spark, root, topic, day, ordered=False).select(
        F.concat(F.lit("lines-"), "topic").alias("name"), F.lit(day).cast("bigint").alias("day"), F.lit(1).cast("bigint").alias("n"))
        for topic, day in days]
    return reduce(DataFrame.unionByName, counted).groupBy("name", "day").agg(F.sum("n").alias("n"))


def mq_stream(spark, sf_dir):
    """Messages of all landed pages, pulled step by step by position; pages below the first offset kept are skipped."""
    rows, root = feeds.events(spark, sf_dir), work_dir(spark, "pulled")
    pages = feeds.mq_pages(rows)
    offsets = rows.groupBy((F.col("event_id") % 3).cast("int").alias("partition")).agg(
        (F.min("event_id") + 10).alias("startOffset"), F.min("event_id").alias("offset"))
    most = rows.agg(F.max("event_id")).first()[0]
    while intake.pull(pages, offsets, root, "first", limit=most // 3 + 1):
        pass
    return intake.pulled(spark, root)


def mq_next_position(spark, sf_dir):
    return mq.next_positions(feeds.mq_pages(feeds.events(spark, sf_dir)))


def partition_progress_rtmp(spark, sf_dir):
    rows = feeds.events(spark, sf_dir)
    messages = feeds.rtmp_messages(rows).withColumn("partition", (F.col("offset") % 9).cast("int"))
    return progress.reached_day(messages, feeds.mq_offsets(rows))


# --- upkeep and progress ----------------------------------------------------


def partition_lag(spark, sf_dir):
    return progress.lag(feeds.mq_offsets(feeds.events(spark, sf_dir)))


def partition_progress(spark, sf_dir):
    rows = feeds.events(spark, sf_dir)
    messages = feeds.hls_messages(rows).withColumn("partition", (F.col("offset") % 9).cast("int"))
    return progress.reached_day(messages, feeds.mq_offsets(rows))


def _unfolded(spark, sf_dir):
    """What plain inserts, one writer per queue partition, would leave: several rows per key."""
    rows = _derived(spark, sf_dir).filter("svr_type = 0")
    day = timekeys.day_of(F.col("timestamp_hour")).alias("timestamp")
    return rows.groupBy("partition", day, "user").agg(
        F.min("offset").alias("first_offset"), F.sum("flux").alias("flux"),
        F.sum("counts").alias("counts"))


def rollup_unique_check(spark, sf_dir):
    return upkeep.duplicate_keys(_unfolded(spark, sf_dir), ["timestamp", "user"])


def rollup_dedup(spark, sf_dir):
    return upkeep.drop_duplicates(_unfolded(spark, sf_dir), ["timestamp", "user"], "first_offset")


def _stored(spark, sf_dir):
    """Folder with partial sums and served tables of both feeds."""
    folder = work_dir(spark, "stored")
    messages = _mixed(spark, sf_dir)
    for feed in ("hls", "rtmp"):
        partials.account_batch(messages, 0, feed, f"{folder}/partials/{feed}", "first")
        served.refresh(spark, feed, f"{folder}/partials/{feed}", f"{folder}/rollups/{feed}")
    return folder


def _tables(spark, folder):
    for name, spec in rollups.CATALOGUE.items():
        yield name, served.table(spark, f"{folder}/rollups/{spec.feed}", name)


def stored_key_check(spark, sf_dir):
    """Rows and different keys of every stored table; both are equal where no key repeats."""
    checks = [
        upkeep.key_counts(table, rollups.keys_of(name)).select(F.lit(name).alias("name"), "n_rows", "n_keys")
        for name, table in _tables(spark, _stored(spark, sf_dir))]
    return reduce(DataFrame.unionByName, checks)


def purge_day(spark, sf_dir):
    """Rows and traffic by time of every stored table, after a day was purged and the rest rebuilt."""
    folder = _stored(spark, sf_dir)
    for feed in ("hls", "rtmp"):
        served.purge_partials(spark, feed, f"{folder}/partials/{feed}", DAY)
        served.purge_rollups(spark, feed, f"{folder}/rollups/{feed}", DAY)
        served.refresh(spark, feed, f"{folder}/partials/{feed}", f"{folder}/rollups/{feed}")
    left = []
    for name, table in _tables(spark, folder):
        time, flux = ("updateTime", "sizeSum") if "updateTime" in table.columns else ("timestamp", "flux")
        left.append(table.groupBy(F.col(time).alias("timestamp")).agg(
            F.count("*").alias("n_rows"), F.sum(flux).alias("flux")).select(F.lit(name).alias("name"), "*"))
    return reduce(DataFrame.unionByName, left)


# --- derivations ------------------------------------------------------------


def hls_valid_filter(spark, sf_dir):
    return hls.accept(hls.read(_mixed(spark, sf_dir))).select("offset", "request_url")


def hls_url_parse(spark, sf_dir):
    return _derived(spark, sf_dir).select("offset", "hls_type", "app", "stream", "slice")


def hls_flags(spark, sf_dir):
    return _derived(spark, sf_dir).select("offset", "svr_type", "http_stat", *HLS_METRICS)


def hls_user_normalise(spark, sf_dir):
    return _derived(spark, sf_dir).select("offset", "user")


def hls_time_keys(spark, sf_dir):
    return _derived(spark, sf_dir).select(
        "offset", "timestamp_hour", timekeys.day_of(F.col("timestamp_hour")).alias("timestamp"))


def hls_base(spark, sf_dir):
    return base.shown(base.base(_requests(spark, sf_dir), "hls"))


def rtmp_derive(spark, sf_dir):
    derived = rtmp.derive(rtmp.accept(rtmp.read(_mixed(spark, sf_dir))))
    return base.shown(derived.select("offset", *RTMP_DIMS, *RTMP_METRICS))


def rtmp_base(spark, sf_dir):
    return base.shown(base.base(_sessions(spark, sf_dir), "rtmp"))


# --- aggregations -----------------------------------------------------------


def _cascade_query(name):
    return lambda spark, sf_dir: base.shown(cascade.rekey(_requests(spark, sf_dir), name))


def _rollup_query(name):
    counters = {"hls": _requests, "rtmp": _sessions}[rollups.CATALOGUE[name].feed]
    return lambda spark, sf_dir: rollups.rollup(counters(spark, sf_dir), name)


def hls_all_levels(spark, sf_dir):
    return base.shown(rollups.all_levels(base.base(_requests(spark, sf_dir), "hls"), "hls"))


def rtmp_all_levels(spark, sf_dir):
    return base.shown(rollups.all_levels(base.base(_sessions(spark, sf_dir), "rtmp"), "rtmp"))


def rtmp_app_stream(spark, sf_dir):
    detail = rollups.rollup(_sessions(spark, sf_dir), "rtmp_down_app_stream")
    return rollups.reduce_keys(detail, ["timestamp", "app", "stream"])


def served_after_stream(spark, sf_dir):
    """Stream, partial sums on disk, rollups on disk, one table out of them."""
    folder = work_dir(spark, "served")
    partials.start_partials(
        feeds.hls_messages(feeds.event_stream(spark, sf_dir)), "hls", f"{folder}/partials", f"{folder}/checkpoint", "first",
        availableNow=True).awaitTermination()
    served.refresh(spark, "hls", f"{folder}/partials", f"{folder}/rollups")
    return served.table(spark, f"{folder}/rollups", "hls_down_app_stream_hour")


# --- range lookup -----------------------------------------------------------


def _geo_query(prefix_bits, strategy="auto"):
    def query(spark, sf_dir):
        probes = feeds.geo_probes(feeds.events(spark, sf_dir))
        return geo.lookup(probes, feeds.geo_ranges(spark, sf_dir), "remote_addr", prefix_bits,
                          strategy)
    return query


QUERIES = {
    "route_topics": route_topics,
    "json_quarantine": json_quarantine,
    "mq_explode": mq_explode,
    "mq_normalise": mq_normalise,
    "archive_by_day": archive_by_day,
    "replay_day": replay_day,
    "stream_hls_partials": stream_hls_partials,
    "stream_rtmp_partials": stream_rtmp_partials,
    "served_after_stream": served_after_stream,
    "handoff_hls": handoff_hls,
    "handoff_rtmp": handoff_rtmp,
    "fold_hls": fold_hls,
    "fold_rtmp": fold_rtmp,
    "hls_wide_values": hls_wide_values,
    "rtmp_wide_values": rtmp_wide_values,
    "json_quarantine_rtmp": json_quarantine_rtmp,
    "archive_stream_by_day": archive_stream_by_day,
    "replay_streamed_day": replay_streamed_day,
    "stream_rewritten_batch": stream_rewritten_batch,
    "serve_hls": serve_hls,
    "serve_rtmp": serve_rtmp,
    "serve_rewritten_batch_hls": serve_rewritten_batch_hls,
    "serve_rewritten_batch_rtmp": serve_rewritten_batch_rtmp,
    "compacted_day": compacted_day,
    "serve_deltas": serve_deltas,
    "replay_sealed_day": replay_sealed_day,
    "partition_progress_indexed": partition_progress_indexed,
    "intake_both_feeds": intake_both_feeds,
    "mq_stream": mq_stream,
    "mq_next_position": mq_next_position,
    "partition_progress_rtmp": partition_progress_rtmp,
    "partition_lag": partition_lag,
    "partition_progress": partition_progress,
    "rollup_unique_check": rollup_unique_check,
    "rollup_dedup": rollup_dedup,
    "stored_key_check": stored_key_check,
    "purge_day": purge_day,
    "hls_valid_filter": hls_valid_filter,
    "hls_url_parse": hls_url_parse,
    "hls_flags": hls_flags,
    "hls_user_normalise": hls_user_normalise,
    "hls_time_keys": hls_time_keys,
    "hls_base": hls_base,
    "rtmp_derive": rtmp_derive,
    "rtmp_base": rtmp_base,
    **{name: _cascade_query(name) for name in cascade.STEPS},
    **{name: _rollup_query(name) for name in rollups.CATALOGUE},
    "hls_all_levels": hls_all_levels,
    "rtmp_all_levels": rtmp_all_levels,
    "rtmp_app_stream": rtmp_app_stream,
    "geo_lookup": _geo_query(8),
    "geo_lookup_16": _geo_query(16),
    "geo_lookup_shuffled": _geo_query(16, "shuffle"),
}
