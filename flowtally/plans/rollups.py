"""The served rollup tables as data, and two ways to compute them.

* :func:`rollup` computes one table from counters of any grain (single
  requests or partial sums) with one shuffle.
* :func:`all_levels` computes every table of a feed in one pass with grouping
  sets. Tables that differ only in direction or in the counters they show
  share a level; :func:`serve` cuts a table out of the pass.
"""

from dataclasses import dataclass

from pyspark.sql import functions as F

from flowtally.functions.timekeys import day_of
from flowtally.plans.base import shown, total
from flowtally.schemas import FRACTION_SUM_TYPE, FRACTIONAL, HLS_METRICS, RTMP_METRICS


@dataclass(frozen=True)
class Rollup:
    """``family`` is the set of counters: quality, detail or legacy."""

    feed: str
    lane: str
    dims: tuple
    family: str
    hourly: bool = False


def _table(feed, lane, family, *dims, hourly=False):
    return Rollup(feed, lane, dims, family, hourly)


# Names, directions, keys and counters of the served tables.
CATALOGUE = {
    "hls_up": _table("hls", "up", "quality"),
    "hls_up_a": _table("hls", "up", "quality", "app"),
    "hls_up_s": _table("hls", "up", "quality", "server_addr"),
    "hls_down": _table("hls", "down", "quality"),
    "hls_down_a": _table("hls", "down", "quality", "app"),
    "hls_down_s": _table("hls", "down", "quality", "server_addr"),
    "hls_down_user": _table("hls", "down", "detail", "user"),
    "hls_down_app_stream": _table("hls", "down", "detail", "user", "app", "stream"),
    "hls_down_httpcode": _table("hls", "down", "detail", "http_stat"),
    "hls_down_user_hour": _table("hls", "down", "detail", "user", hourly=True),
    "hls_down_app_stream_hour": _table(
        "hls", "down", "detail", "user", "app", "stream", hourly=True),
    "hls_day_data": _table("hls", "down", "legacy"),
    "hls_user_data": _table("hls", "down", "legacy", "user"),
    "hls_stream_data": _table("hls", "down", "legacy", "user", "app", "stream"),
    "hls_up_app_stream": _table("hls", "up", "detail", "user", "app", "stream"),
    "hls_up_app_stream_hour": _table("hls", "up", "detail", "user", "app", "stream", hourly=True),
    "hls_up_user": _table("hls", "up", "detail", "user"),
    "hls_up_user_hour": _table("hls", "up", "detail", "user", hourly=True),
    "hls_up_httpcode": _table("hls", "up", "detail", "http_stat"),
    "rtmp_down": _table("rtmp", "down", "quality"),
    "rtmp_down_app": _table("rtmp", "down", "quality", "app"),
    "rtmp_down_server": _table("rtmp", "down", "quality", "svr_ip"),
    "rtmp_forward": _table("rtmp", "forward", "quality"),
    "rtmp_forward_app": _table("rtmp", "forward", "quality", "app"),
    "rtmp_forward_server": _table("rtmp", "forward", "quality", "svr_ip"),
    "rtmp_up": _table("rtmp", "up", "quality"),
    "rtmp_up_app": _table("rtmp", "up", "quality", "app"),
    "rtmp_up_server": _table("rtmp", "up", "quality", "svr_ip"),
    "rtmp_down_user": _table("rtmp", "down", "detail", "user"),
    "rtmp_down_app_stream": _table("rtmp", "down", "detail", "user", "app", "stream"),
    "rtmp_down_user_hour": _table("rtmp", "down", "detail", "user", hourly=True),
    "rtmp_down_app_stream_hour": _table(
        "rtmp", "down", "detail", "user", "app", "stream", hourly=True),
    "rtmp_up_app_stream": _table("rtmp", "up", "detail", "user", "app", "stream"),
    "rtmp_up_app_stream_hour": _table(
        "rtmp", "up", "detail", "user", "app", "stream", hourly=True),
    "rtmp_up_user": _table("rtmp", "up", "detail", "user"),
    "rtmp_up_user_hour": _table("rtmp", "up", "detail", "user", hourly=True),
    "rtmp_forward_app_stream": _table("rtmp", "forward", "detail", "user", "app", "stream"),
    "rtmp_forward_app_stream_hour": _table(
        "rtmp", "forward", "detail", "user", "app", "stream", hourly=True),
    "rtmp_forward_user": _table("rtmp", "forward", "detail", "user"),
    "rtmp_forward_user_hour": _table("rtmp", "forward", "detail", "user", hourly=True),
}

# Counters of the families.
_SPLIT = [
    "fluency_counts", "nlt_400_counts", "mt_1_counts", "mt_3_counts", "request_time", "counts",
]
_HLS_QUALITY = [*[f"{m}_m3" for m in _SPLIT], *[f"{m}_ts" for m in _SPLIT], "flux"]
_HLS_DETAIL = ["flux", "valid_counts", "request_time", "counts", "fluency_counts"]
_HLS_LEGACY = {
    "sizeSum": "flux", "count": "valid_counts", "reqTime": "request_time",
    "fluency": "fluency_counts",
}
_RTMP_DETAIL = ["flux", "valid_counts", "total_counts"]
_SHOWN_AS = {"http_stat": "httpCode"}


def keys_of(name):
    """Key columns of a served table, as it shows them."""
    spec = CATALOGUE[name]
    time = "updateTime" if spec.family == "legacy" else "timestamp"
    return [time, *[_SHOWN_AS.get(d, d) for d in spec.dims]]


def _split_sums(kinds):
    """HLS counters apart for playlists (and unparsed URLs) and for segments."""
    is_segment = F.col("hls_type") == "ts"
    sums = {}
    for side in ("m3", "ts"):
        for m in _SPLIT:
            zero = F.lit(0).cast(kinds[m])
            value = F.when(is_segment == F.lit(side == "ts"), F.col(m)).otherwise(zero)
            sums[f"{m}_{side}"] = total(value, m, kinds[m])
    return sums


def _sums(feed, family, kinds):
    """Counter name -> sum over the counters of the input, whose column types are ``kinds``."""
    def plain(metric):
        return total(F.col(metric), metric, kinds[metric])

    if feed == "rtmp":
        return {m: plain(m) for m in (RTMP_METRICS if family == "quality" else _RTMP_DETAIL)}
    if family == "quality":
        return {**_split_sums(kinds), "flux": plain("flux")}
    if family == "detail":
        return {m: plain(m) for m in _HLS_DETAIL}
    return {shown_as: plain(m) for shown_as, m in _HLS_LEGACY.items()}


def _counters(feed, family):
    """Counter names of a family, in order."""
    if feed == "rtmp":
        return RTMP_METRICS if family == "quality" else _RTMP_DETAIL
    return {"quality": _HLS_QUALITY, "detail": _HLS_DETAIL, "legacy": list(_HLS_LEGACY)}[family]


def _named(sums):
    return [value.alias(name) for name, value in sums.items()]


def _lane(feed):
    """Direction every request or session counts for in the totals."""
    if feed == "hls":
        return F.when(F.col("svr_type") == 1, "up").otherwise("down")
    return (
        F.when(F.col("cmd") == "play", "down").when(F.col("cmd") == "forward", "forward")
        .otherwise("up")
    )


def _exact_lane(feed):
    """Direction in the detail tables; NULL for HLS server types other than 0 and 1."""
    if feed == "hls":
        return F.when(F.col("svr_type") == 1, "up").when(F.col("svr_type") == 0, "down")
    return _lane(feed)


def rollup(counters, name, show=shown):
    """One served table from requests, sessions or partial sums; ``show`` gives totals the types of readers."""
    spec = CATALOGUE[name]
    lane = _lane(spec.feed) if spec.family == "quality" else _exact_lane(spec.feed)
    hour = F.col("timestamp_hour")
    time, *dims = keys_of(name)
    keys = [(hour if spec.hourly else day_of(hour)).alias(time)]
    keys += [F.col(d).alias(shown_as) for d, shown_as in zip(spec.dims, dims)]
    return show(counters.filter(lane == spec.lane).groupBy(*keys).agg(
        *_named(_sums(spec.feed, spec.family, dict(counters.dtypes)))))


def reduce_keys(served, keys):
    """A coarser table from a served one, for example without its user.

    Fractions are added as decimals, so the order of tasks changes no total.
    """
    counters = [c for c in served.columns if c not in _all_keys()]
    return shown(served.groupBy(*keys).agg(
        *[total(F.col(c).cast(FRACTION_SUM_TYPE) if c in FRACTIONAL else F.col(c), c, "bigint").alias(c)
          for c in counters]))


def _all_keys():
    return {key for name in CATALOGUE for key in keys_of(name)}


# --- one pass over all tables of a feed ------------------------------------


def level_of(name):
    """Tables with the same level are rows and columns of the same grouping set."""
    spec = CATALOGUE[name]
    kind = "total" if spec.family == "quality" or spec.feed == "rtmp" else "detail"
    return "-".join([kind, "hour" if spec.hourly else "day", *spec.dims])


def levels_of(feed):
    """Level -> key columns of its grouping set."""
    levels = {}
    for name, spec in CATALOGUE.items():
        if spec.feed == feed:
            level = level_of(name)
            lane = "exact_lane" if level.startswith("detail") else "lane"
            # An hour key always comes with its day, so that levels share the partition column.
            time = ["day", "hour"] if spec.hourly else ["day"]
            levels[level] = [lane, *time, *spec.dims]
    return levels


def _level_sums(feed, kinds):
    """Sums from which every family can be shown."""
    sums = _sums(feed, "quality", kinds)
    return sums if feed == "rtmp" else {**sums, "valid_counts": F.sum("valid_counts")}


def all_levels(counters, feed):
    """Every level of a feed in one grouping-sets pass.

    ``level`` comes from the grouping id, never from NULL keys: a key may be
    NULL itself.
    """
    levels = levels_of(feed)
    columns = []
    for keys in levels.values():
        columns += [k for k in keys if k not in columns]
    prepared = counters.withColumns({
        "lane": _lane(feed), "exact_lane": _exact_lane(feed),
        "day": day_of(F.col("timestamp_hour")).cast("int"), "hour": F.col("timestamp_hour"),
    })
    passed = prepared.groupingSets([[F.col(k) for k in keys] for keys in levels.values()],
                                   *[F.col(c) for c in columns]).agg(
        F.grouping_id().alias("_set"), *_named(_level_sums(feed, dict(counters.dtypes))))
    level = None
    for name, keys in levels.items():
        set_id = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        hit = F.col("_set") == set_id
        level = F.when(hit, name) if level is None else level.when(hit, name)
    labelled = passed.withColumn("level", level).withColumn(
        "lane", F.coalesce("lane", "exact_lane") if "exact_lane" in columns else F.col("lane"))
    # Detail rows without a direction belong to no table.
    sums = list(_level_sums(feed, dict(counters.dtypes)))
    dims = [c for c in columns if c not in ("lane", "exact_lane", "day")]
    return labelled.filter(F.col("lane").isNotNull()).select(
        "lane", *dims, *sums, "level", "day")


def serve(levels, name):
    """One served table out of the rows of :func:`all_levels`."""
    spec = CATALOGUE[name]
    rows = levels.filter((F.col("level") == level_of(name)) & (F.col("lane") == spec.lane))
    time, *dims = keys_of(name)
    keys = [F.col("hour" if spec.hourly else "day").cast("bigint").alias(time)]
    keys += [F.col(d).alias(shown_as) for d, shown_as in zip(spec.dims, dims)]

    def counter(metric):
        if spec.feed == "hls" and spec.family != "quality" and metric in _SPLIT:
            return F.col(f"{metric}_m3") + F.col(f"{metric}_ts")
        return F.col(metric)

    if spec.feed == "hls" and spec.family == "legacy":
        counters = {shown_as: counter(m) for shown_as, m in _HLS_LEGACY.items()}
    else:
        counters = {m: counter(m) for m in _counters(spec.feed, spec.family)}
    return shown(rows.select(*keys, *_named(counters)))


# --- totals by hour, which are kept and added to -----------------------------


def hour_level_of(name):
    """Tables with the same level show the same rows of :func:`hour_levels`."""
    spec = CATALOGUE[name]
    kind = "total" if spec.family == "quality" or spec.feed == "rtmp" else "detail"
    return "-".join([kind, *spec.dims])


def hour_counts(feed):
    """Counters of :func:`hour_levels`, and those whose sum is the number of requests or sessions of a row."""
    kinds = dict.fromkeys([*HLS_METRICS, *RTMP_METRICS], "bigint")
    rows = ["counts_m3", "counts_ts"] if feed == "hls" else ["total_counts"]
    return {"sums": list(_level_sums(feed, kinds)), "rows": rows}


def hour_levels(counters, feed):
    """Every level of a feed by hour in one grouping-sets pass, the day last.

    Sums of these rows over hours are the rows of the daily tables.
    """
    levels = {}
    for name, spec in CATALOGUE.items():
        if spec.feed == feed:
            level = hour_level_of(name)
            levels[level] = ["exact_lane" if level.startswith("detail") else "lane", *spec.dims]
    columns = list(dict.fromkeys(k for keys in levels.values() for k in keys))
    prepared = counters.withColumns({
        "lane": _lane(feed), "exact_lane": _exact_lane(feed), "hour": F.col("timestamp_hour"),
        "day": day_of(F.col("timestamp_hour")).cast("int")})
    sums = _level_sums(feed, dict(counters.dtypes))
    passed = prepared.groupingSets(
        [[F.col(k) for k in ("day", "hour", *keys)] for keys in levels.values()],
        *[F.col(c) for c in ("day", "hour", *columns)]).agg(F.grouping_id().alias("_set"), *_named(sums))
    level = F.lit(None).cast("string")
    for name, keys in levels.items():
        set_id = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys)
        level = F.when(F.col("_set") == set_id, name).otherwise(level)
    lane = F.coalesce("lane", "exact_lane") if "exact_lane" in columns else F.col("lane")
    dims = [c for c in columns if c not in ("lane", "exact_lane")]
    return passed.select(lane.alias("lane"), *dims, "hour", *sums, level.alias("level"), "day").filter(F.col("lane").isNotNull())


def serve_hours(hours, name):
    """One served table out of the rows of :func:`hour_levels`; a daily one adds up its hours."""
    spec = CATALOGUE[name]
    rows = hours.filter((F.col("level") == hour_level_of(name)) & (F.col("lane") == spec.lane))
    time, *dims = keys_of(name)
    keys = [F.col("hour" if spec.hourly else "day").cast("bigint").alias(time)]
    keys += [F.col(d).alias(shown_as) for d, shown_as in zip(spec.dims, dims)]

    def counter(metric):
        if spec.feed == "hls" and spec.family != "quality" and metric in _SPLIT:
            return F.col(f"{metric}_m3") + F.col(f"{metric}_ts")
        return F.col(metric)

    if spec.feed == "hls" and spec.family == "legacy":
        counters = {shown_as: counter(m) for shown_as, m in _HLS_LEGACY.items()}
    else:
        counters = {m: counter(m) for m in _counters(spec.feed, spec.family)}
    if spec.hourly:
        return shown(rows.select(*keys, *_named(counters)))
    kinds = dict(rows.select(*_named(counters)).dtypes)
    return shown(rows.groupBy(*keys).agg(*[F.sum(value).cast(kinds[c]).alias(c) for c, value in counters.items()]))
