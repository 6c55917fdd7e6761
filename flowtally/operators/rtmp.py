"""RTMP session report: one session in, its keys and additive counters out."""

from pyspark.sql import functions as F

from flowtally.functions import numbers, timekeys, users
from flowtally.operators.decode import MALFORMED, decode, quarantine, route
from flowtally.schemas import FRACTION_SUM_TYPE, RTMP_DIMS, RTMP_METRICS, RTMP_RECORD, RTMP_TOPIC

# Fixed value: shortest publishing time, in milliseconds, of a valid session.
VALID_PUBLISH_MS = 30000

_FLUENCY = ["PlayFluency", "PlayFluencyIn60s", "Max60sFluency", "Min60sFluency"]
_WHOLE = [
    "PublishTime", "PlayTime", "EmptyNumbers", "EmptyTime", "MaxEmptyTime", "FirstBufferTime",
    "EmptyNumbersIn60s", "EmptyTimeIn60s",
]
_NAMES = ["Cmd", "App", "Stream", "SvrIp"]


def read(frame):
    """Common frame -> decoded session reports with their numbers, malformed ones included."""
    return _numbers(decode(route(frame, RTMP_TOPIC), RTMP_RECORD))


def _fluency_time(time, fluency):
    """Play time times fluency, exact; NULL beyond 10^25.

    A product of both as they are would lose digits to its precision, so the
    whole part and the fraction are multiplied apart.
    """
    time, whole = time.cast("decimal(19,0)"), F.floor(fluency).cast("decimal(18,0)")
    # The types are so narrow that their sum keeps its twelve places.
    product = (time * whole).try_cast("decimal(37,12)")
    return (product + time * (fluency - whole).cast("decimal(12,12)")).cast(FRACTION_SUM_TYPE)


def _numbers(decoded):
    """Decoded reports with their numbers, NULL where a text is none, next to the fields.

    The generators make the conversion a step of its own: it is worked out once for each
    message, and filters and derived columns read its results.
    """
    epoch = F.coalesce("EndTime", F.lit("0"))
    flux = F.when(F.col("Cmd") == "play", F.col("SendByteSum")).otherwise(F.col("RecvByteSum"))
    found = [numbers.whole(F.col(name)).alias(f"_{name}") for name in _WHOLE]
    found += [numbers.fraction(F.col(name)).alias(f"_{name}") for name in _FLUENCY]
    found += [F.when(numbers.is_epoch(epoch), numbers.epoch_seconds(epoch)).alias("_epoch"), numbers.whole(flux).alias("_flux")]
    taken = decoded.select("*", F.inline(F.array(F.struct(*found))))
    time = F.struct(_fluency_time(F.col("_PlayTime"), F.col("_PlayFluency")).alias("_play_fluency_time"))
    return taken.select("*", F.inline(F.array(time)))


_TAKEN = [f"_{name}" for name in [*_WHOLE, *_FLUENCY]] + ["_epoch", "_flux", "_play_fluency_time"]


def _fit():
    """Only ``EndTime``, ``User`` and the byte sum of the other direction may be missing."""
    fit = ~F.col("malformed")
    for name in [*_NAMES, *_TAKEN]:
        fit = fit & F.col(name).isNotNull()
    return F.coalesce(fit, F.lit(False))


def accept(decoded):
    return decoded.filter(_fit())


def reject_reason():
    """NULL for usable reports; malformed messages, missing fields, unusable numbers."""
    missing = F.when(F.col("Cmd") == "play", F.col("SendByteSum")).otherwise(F.col("RecvByteSum")).isNull()
    for name in [*_NAMES, *_WHOLE, *_FLUENCY]:
        missing = missing | F.col(name).isNull()
    return F.when(~_fit(), (
        F.when(F.col("malformed"), MALFORMED)
        .when(missing, "missing_field")
        .when(F.col("_epoch").isNull(), "bad_end_time")
        .otherwise("bad_metric")
    ))


def rejects(decoded):
    return quarantine(decoded, reject_reason())


def derive(accepted, tz=timekeys.DEFAULT_TZ):
    """Keys and counters of accepted sessions, next to the fields they come from.

    Fluency, longest gap and the 60-second extremes are counters like all
    others: totals are sums of them.
    """
    whole = {name: F.col(f"_{name}") for name in _WHOLE}
    fluency = {name: F.col(f"_{name}") for name in _FLUENCY}
    return accepted.withColumn("local", timekeys.local_seconds(F.col("_epoch"), tz)).withColumns({
        "cmd": F.col("Cmd"),
        "timestamp_hour": timekeys.hour_key(F.col("local")),
        "app": F.col("App"),
        "stream": F.col("Stream"),
        "user": users.rtmp_user(F.col("User")),
        "svr_ip": F.col("SvrIp"),
        "valid_counts": (whole["PublishTime"] >= VALID_PUBLISH_MS).cast("bigint"),
        "total_counts": F.lit(1).cast("bigint"),
        "play_fluency": fluency["PlayFluency"],
        "play_fluency_in60s": fluency["PlayFluencyIn60s"],
        "publish_time": whole["PublishTime"],
        "play_fluency_time": F.col("_play_fluency_time"),
        "empty_numbers": whole["EmptyNumbers"],
        "empty_time": whole["EmptyTime"],
        "max_empty_time": whole["MaxEmptyTime"],
        "first_buffer_time": whole["FirstBufferTime"],
        "empty_numbers_in60s": whole["EmptyNumbersIn60s"],
        "empty_time_in60s": whole["EmptyTimeIn60s"],
        "play_fluency_zero_counts": (fluency["PlayFluency"] == 0).cast("bigint"),
        "max60s_fluency": fluency["Max60sFluency"],
        "min60s_fluency": fluency["Min60sFluency"],
        "flux": F.col("_flux"),
    })


def sessions(frame, tz=timekeys.DEFAULT_TZ):
    """Common frame -> one row of keys and counters per accepted session."""
    return derive(accept(read(frame)), tz).select(*RTMP_DIMS, *RTMP_METRICS)
