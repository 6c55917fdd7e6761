"""Served rollups on disk: totals by hour, kept up to date by signed deltas.

The kept state holds a row per hour, level and key, a part per day. A fold takes
the partial sums that were committed since the last one, minus those that were
replaced or purged, and adds them to the rows of the days they touch; no other
sums are read. It commits the new rows together with the commit of the partial sums it has
got to, so a fold that is run again, or was stopped anywhere, counts nothing
twice. Keys whose count falls to zero go.

A day's tables are sums over its hours, worked out when they are read. File rows are
sorted by level, so reading one table skips the row groups of the others.
"""

from pyspark.sql import functions as F

from flowtally.plans.base import COUNTERS, KEYS
from flowtally.plans.rollups import CATALOGUE, hour_counts, hour_levels, serve_hours
from flowtally.schemas import partials_schema
from flowtally.streaming import ledger, partials

HOURS = "hours"


def _signed(sums, feed, sign):
    """Partial sums, as they are or to be taken away."""
    if sign > 0:
        return sums
    return sums.withColumns({m: -F.col(m) for m in COUNTERS[feed]})


def _hour_schema(spark, feed):
    """Schema of the kept hours, from the plan that writes them."""
    empty = spark.createDataFrame([], partials_schema(KEYS[feed], COUNTERS[feed]))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in hour_levels(empty, feed).schema]
    return ", ".join([*fields, "run string", "batch_id bigint", "attempt string"])


def _read_hours(log, feed, parts):
    return log.read(parts, HOURS, _hour_schema(log.spark, feed)).drop("run", "batch_id", "attempt")


def changes(spark, feed, partials_path, rollups_path, days=(), table=partials.SUMS):
    """What a fold has to add: (version it gets to, parts to add, parts to take away, days to rebuild).

    Days to rebuild, those given and those removed from the rollups, are added
    from all their parts. So is everything where nothing is kept yet.
    """
    source, kept = ledger.Ledger(spark, partials_path), ledger.Ledger(spark, rollups_path)
    note = kept.state()[2]
    done = note.get("folded", 0)
    now, parts, _ = source.state()
    rebuilt = {int(day) for day in days} | {int(day) for day in note.get("dropped", [])}
    after = ledger.of_table(parts, table)
    if not done:
        return now, after, [], rebuilt
    old = ledger.leaves(ledger.of_table(source.state(done)[1], table))
    new = ledger.leaves(after)

    def kept_day(part):
        return int(part["keys"]["day"]) not in rebuilt

    add = [part for name, part in new.items() if name not in old and kept_day(part)]
    take = [part for name, part in old.items() if name not in new and kept_day(part)]
    return now, add + [part for part in after if not kept_day(part)], take, rebuilt


def fold(spark, feed, partials_path, rollups_path, days=(), table=partials.SUMS):
    """Bring the kept hours up to the last commit of the partial sums; ``days`` are rebuilt from all their sums.

    Gives the version it got to.
    """
    source, kept = ledger.Ledger(spark, partials_path), ledger.Ledger(spark, rollups_path)
    begun, hours, note = kept.state()
    now, add, take, rebuilt = changes(spark, feed, partials_path, rollups_path, days, table)
    if now == note.get("folded", 0) and not rebuilt:
        return now

    def commit(parts, gone):
        def change(_, current):
            # Another fold that was faster has added the same sums.
            if current.get("folded", 0) != note.get("folded", 0) or current.get("dropped", []) != note.get("dropped", []):
                return None
            return parts, gone, {"folded": now, "dropped": []}

        kept.commit("fold", change)
        return now

    stale = [part for part in hours.values() if int(part["keys"]["day"]) in rebuilt]
    if not add and not take:
        return commit([], [part["id"] for part in stale])
    signed = [_signed(partials.read_parts(source, feed, parts, table), feed, sign)
              for parts, sign in ((add, 1), (take, -1)) if parts]
    delta = hour_levels(signed[0] if len(signed) == 1 else signed[0].unionByName(signed[1]), feed)
    touched = {part["keys"]["day"] for part in [*add, *take]}
    before = [part for part in hours.values()
              if part["keys"]["day"] in touched and int(part["keys"]["day"]) not in rebuilt]
    kept_columns = _read_hours(kept, feed, []).columns
    counters = hour_counts(feed)
    totals = delta.select(*kept_columns)
    # The delta has a row per key already; only where rows are kept the two have to be added.
    if before:
        rows = _read_hours(kept, feed, before).unionByName(totals)
        kinds = dict(rows.dtypes)
        keys = [c for c in rows.columns if c not in kinds or c not in counters["sums"]]
        totals = rows.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in counters["sums"]])
    alive = totals.filter(" + ".join(counters["rows"]) + " <> 0")
    parts = kept.write(alive.sortWithinPartitions("level"), HOURS, feed, now, "day")
    return commit(parts, [part["id"] for part in [*before, *stale]])


def refresh(spark, feed, partials_path, rollups_path, days=None):
    """Bring the rollups up to date; ``days``, a list or a DataFrame with a column ``day``, are rebuilt from all their sums.

    None rebuilds every day that has partial sums or rollups.
    """
    if days is None:
        kept = ledger.Ledger(spark, rollups_path).state()[1]
        stored = ledger.Ledger(spark, partials_path).state()[1]
        days = {part["keys"]["day"] for part in [*kept.values(), *ledger.of_table(stored, partials.SUMS)]}
    elif not isinstance(days, (list, tuple, set)):
        # A few hundred thousand days at most can be told apart.
        days = [row["day"] for row in days.filter(F.col("day") >= 0).select("day").distinct().collect()]
    return fold(spark, feed, partials_path, rollups_path, days)


def follow(spark, feed, partials_path, rollups_path, checkpoint, table=partials.SUMS, **trigger):
    """Keep served tables up to date: a query that folds what commits of partial sums add and take away.

    The commits wake it up; how far the rollups got is told by their own log.
    The default trigger is every 300 seconds.
    """
    log = ledger.Ledger(spark, partials_path).create()

    def wake(batch, _):
        fold(spark, feed, partials_path, rollups_path, table=table)

    return (
        spark.readStream.schema("value string").option("wholetext", "true").text(log)
        .writeStream.foreachBatch(wake).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "300 seconds"})).start()
    )


def touched_days(spark, partials_path, feed, run, batch_ids):
    """Days that the given micro-batches wrote to."""
    parts = ledger.leaves(ledger.of_table(ledger.Ledger(spark, partials_path).state()[1], partials.SUMS)).values()
    return ledger.days_frame(spark, {
        int(part["keys"]["day"]) for part in parts if part["run"] == run and part["batch_id"] in batch_ids})


def table(spark, rollups_path, name, days=None):
    """One served table; only the folders of ``days``, if given, and row groups of its level are read."""
    log = ledger.Ledger(spark, rollups_path)
    parts = ledger.of_table(log.state()[1], HOURS)
    if days is not None:
        parts = [part for part in parts if int(part["keys"]["day"]) in set(days)]
    stored = _read_hours(log, CATALOGUE[name].feed, parts)
    if days is not None:
        stored = stored.filter(F.col("day").isin(*days))
    return serve_hours(stored, name)


def purge_partials(spark, feed, partials_path, day):
    """Remove the partial sums of one day; batches that come later count again."""
    return partials.purge(spark, partials_path, day)


def purge_rollups(spark, feed, rollups_path, day):
    """Remove one day from every rollup of a feed, until the next fold, which rebuilds it from the sums left."""
    def change(parts, note):
        dropped = sorted({*note.get("dropped", []), int(day)})
        return [], [part["id"] for part in ledger.of_table(parts, HOURS, day=day)], {"dropped": dropped}

    return ledger.Ledger(spark, rollups_path).commit("purge", change)
