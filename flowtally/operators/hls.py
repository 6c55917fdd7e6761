"""HTTP segment access log: one request in, its keys and additive counters out."""

from pyspark.sql import functions as F

from flowtally.functions import numbers, timekeys, urls, users
from flowtally.operators.decode import MALFORMED, decode, quarantine, route
from flowtally.schemas import HLS_DIMS, HLS_METRICS, HLS_RECORD, HLS_TOPIC

# Thresholds in milliseconds.
SLOW_MS = 1000
VERY_SLOW_MS = 3000
SMOOTH_SLICE_RATIO = 3


def read(frame):
    """Common frame -> decoded access-log records, malformed ones included."""
    return decode(route(frame, HLS_TOPIC), HLS_RECORD)


def _problems():
    """What makes a media request unusable, by reason; missing fields have defaults."""
    return {
        "bad_request_time": ~numbers.is_seconds(F.coalesce("request_time", F.lit("0"))),
        "bad_unix_time": ~numbers.is_epoch(F.coalesce("unix_time", F.lit("0"))),
        "bad_body_bytes_sent": numbers.whole(F.coalesce("body_bytes_sent", F.lit("0"))).isNull(),
    }


def accept(decoded):
    """Playlist and segment requests whose numbers can be used."""
    fit = ~F.col("malformed") & urls.is_media(F.col("request_url"))
    for problem in _problems().values():
        fit = fit & ~problem
    return decoded.filter(fit)


def reject_reason():
    """NULL for everything but malformed messages and media requests with unusable numbers."""
    reason = F.when(F.col("malformed"), MALFORMED)
    for name, problem in _problems().items():
        reason = reason.when(urls.is_media(F.col("request_url")) & problem, name)
    return reason


def rejects(decoded):
    return quarantine(decoded, reject_reason())


def derive(accepted, tz=timekeys.DEFAULT_TZ, slice_compare="numeric"):
    """Keys and counters of accepted requests, next to the intermediate columns.

    * A request is valid when its status is below 400 and not 202. A status
      that is missing or no number counts as 0, hence valid. A server type that
      is no number is -1: down in totals, in no detail table.
    * A playlist request is smooth when valid and faster than one second; a
      segment request when valid and its slice is longer than three times the
      request time. A slice length that is not a number is never smooth.
      ``slice_compare="text"`` takes every slice as long enough: that is the
      outcome where text compares greater than any number.
    * A URL that cannot be parsed keeps its counters under type, application
      and stream ``error`` and is never smooth.
    """
    if slice_compare not in ("numeric", "text"):
        raise ValueError("slice_compare is 'numeric' or 'text'")
    # A status beyond int is the largest int, hence no valid one.
    status = F.least(F.coalesce(numbers.whole(F.col("http_stat")), F.lit(0)), F.lit(2**31 - 1)).try_cast("int")
    status = F.coalesce(status, F.lit(0))
    server_type = F.when(F.col("svr_type").isNull(), 0).otherwise(
        F.coalesce(numbers.whole(F.col("svr_type")).try_cast("int"), F.lit(-1)))
    tokenised = accepted.withColumns({
        "tokens": urls.tokens(F.col("request_url")),
        "is_playlist": F.col("request_url").contains(".m3u8"),
        "svr_type": server_type,
        "http_stat": status,
        "valid": (status < 400) & (status != 202),
        "millis": numbers.seconds_to_millis(F.coalesce("request_time", F.lit("0"))),
        "local": timekeys.local_seconds(
            numbers.epoch_seconds(F.coalesce("unix_time", F.lit("0"))), tz),
        "user": users.hls_user(F.col("user")),
        "server_addr": F.coalesce("server_addr", F.lit("error_server_addr")),
    })
    t, playlist = F.col("tokens"), F.col("is_playlist")
    named = tokenised.withColumn("parts", urls.segment_parts(t)).withColumns({
        "app": F.when(playlist, urls.playlist_app(t)).otherwise(urls.segment_app(t)),
        "stream": F.when(playlist, urls.playlist_stream(t))
        .otherwise(urls.segment_stream(F.col("parts"))),
        "slice": F.when(~playlist, urls.segment_slice(F.col("parts"))),
    }).withColumn("parsed", F.col("app").isNotNull() & F.col("stream").isNotNull())
    parsed, valid, millis = F.col("parsed"), F.col("valid"), F.col("millis")
    long_enough = F.lit(True)
    if slice_compare == "numeric":
        long_enough = F.col("slice").try_cast("bigint") > millis * SMOOTH_SLICE_RATIO
    smooth = parsed & valid & F.when(playlist, millis < SLOW_MS).otherwise(long_enough)
    return named.withColumns({
        "hls_type": F.when(~parsed, "error").when(playlist, "m3u8").otherwise("ts"),
        "app": F.when(parsed, F.col("app")).otherwise("error"),
        "stream": F.when(parsed, F.col("stream")).otherwise("error"),
        "timestamp_hour": timekeys.hour_key(F.col("local")),
        "nlt_400_counts": (F.col("http_stat") >= 400).cast("bigint"),
        "mt_1_counts": (millis > SLOW_MS).cast("bigint"),
        "mt_3_counts": (millis > VERY_SLOW_MS).cast("bigint"),
        "flux": F.when(valid, numbers.whole(F.coalesce("body_bytes_sent", F.lit("0"))))
        .otherwise(F.lit(0).cast("bigint")),
        "request_time": millis,
        "fluency_counts": F.coalesce(smooth, F.lit(False)).cast("bigint"),
        "valid_counts": valid.cast("bigint"),
        "counts": F.lit(1).cast("bigint"),
    })


def requests(frame, tz=timekeys.DEFAULT_TZ, slice_compare="numeric"):
    """Common frame -> one row of keys and counters per accepted media request."""
    return derive(accept(read(frame)), tz, slice_compare).select(*HLS_DIMS, *HLS_METRICS)
