"""Record schemas, key columns and metric columns.

Field and column names are fixed values: they are the names in the log
records and in the served tables.
"""

# Topic names, which are also the message keys.
HLS_TOPIC = "nodeHls"
RTMP_TOPIC = "RtmpFluence"

# The shape every source produces and every pipeline starts from.
FRAME = (
    "key string, value string, topic string, partition int, offset bigint, timestamp timestamp"
)

# Fractional fields and counters are decimals, so that a total does not depend
# on the order in which partial sums meet. Twelve places keep what a double
# tells about a percentage. Readers see doubles.
FRACTION_TYPE = "decimal(30,12)"
FRACTION_SUM_TYPE = "decimal(38,12)"
# Sums of counters that carry values of the records: any number of bigints
# adds up without an overflow. Readers see bigints.
WIDE_SUM_TYPE = "decimal(38,0)"

# Only the fields the accounting needs: the JSON reader skips all others.
# All are read as text: the feeds send numbers as text, whole or with a fraction.
HLS_RECORD = dict.fromkeys([
    "request_url", "server_addr", "remote_addr", "svr_type", "http_stat", "request_time", "user",
    "body_bytes_sent", "unix_time",
], "string")
RTMP_RECORD = dict.fromkeys([
    "Cmd", "EndTime", "App", "Stream", "User", "SvrIp", "SendByteSum", "RecvByteSum", "PublishTime",
    "PlayTime", "PlayFluency", "PlayFluencyIn60s", "EmptyNumbers", "EmptyTime", "MaxEmptyTime",
    "FirstBufferTime", "EmptyNumbersIn60s", "EmptyTimeIn60s", "Max60sFluency", "Min60sFluency",
], "string")

MQ_PAGE = "nextOffset bigint, list array<struct<body: string, offset: bigint>>"

# Key and counter columns of the per-batch partial sums.
HLS_DIMS = [
    "svr_type", "hls_type", "timestamp_hour", "app", "stream", "user", "server_addr", "http_stat",
]
HLS_METRICS = [
    "nlt_400_counts", "mt_1_counts", "mt_3_counts", "flux",
    "request_time", "fluency_counts", "valid_counts", "counts",
]
RTMP_DIMS = ["cmd", "timestamp_hour", "app", "stream", "user", "svr_ip"]
RTMP_METRICS = [
    "valid_counts", "total_counts", "play_fluency", "play_fluency_in60s", "publish_time",
    "play_fluency_time", "empty_numbers", "empty_time", "max_empty_time", "first_buffer_time",
    "empty_numbers_in60s", "empty_time_in60s", "play_fluency_zero_counts", "max60s_fluency",
    "min60s_fluency", "flux",
]

FRACTIONAL = {
    "play_fluency", "play_fluency_in60s", "play_fluency_time", "max60s_fluency", "min60s_fluency",
}

WIDE = {
    "flux", "request_time", "publish_time", "empty_numbers", "empty_time", "max_empty_time",
    "first_buffer_time", "empty_numbers_in60s", "empty_time_in60s",
}

# Partial-sum tables as they lie on disk, partition columns last.
_TYPES = {
    "svr_type": "int", "http_stat": "int", "timestamp_hour": "bigint",
    **{m: "bigint" for m in HLS_METRICS + RTMP_METRICS},
    **{m: FRACTION_SUM_TYPE for m in FRACTIONAL}, **{m: WIDE_SUM_TYPE for m in WIDE},
}


def kind_of(column):
    """Type of a key or counter in partial sums."""
    return _TYPES.get(column, "string")


def partials_schema(dims, metrics):
    """Schema of a partial-sum table: keys, counters, then its partition columns."""
    columns = [f"`{c}` {kind_of(c)}" for c in [*dims, *metrics]]
    return ", ".join([*columns, "day int, run string, batch_id bigint"])
