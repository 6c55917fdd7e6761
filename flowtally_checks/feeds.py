"""Log feeds derived from the given tables.

Every function turns a whole table into messages of the shape a real source
delivers: records become JSON text (absent fields stay absent), so that the
queries exercise decoding as well.
"""

from pyspark.sql import functions as F

from flowtally.schemas import HLS_TOPIC, RTMP_TOPIC

# Epoch seconds of a zone-less time, taken as UTC whatever the session's zone.
_EPOCH = """unix_date(cast(ts as date)) * 86400L + hour(ts) * 3600 + minute(ts) * 60 + second(ts)
 as epoch"""


def events(spark, sf_dir):
    """The event table, dealt over the cores: a few files would leave the decoding of all messages to a few tasks.

    The number of tasks is given, as small rows would be gathered in one task again.
    """
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").repartition(parts, "event_id")


def event_stream(spark, sf_dir):
    """The event table as a stream of its files, at most a tebibyte per micro-batch."""
    reader = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema)
    # The file source takes folders or patterns; this pattern matches the one name only.
    return reader.option("maxBytesPerTrigger", 2**40).parquet(f"{sf_dir}/events.parque[t]")


def _message(topic, value):
    return [
        F.lit(topic).alias("key"),
        value.alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.to_timestamp(F.lit("2024-02-01 00:00:00")).alias("timestamp"),
    ]


def hls_messages(rows):
    """Events -> access-log messages."""
    fields = rows.selectExpr(
        "event_id",
        _EPOCH,
        """case
 when event_id%12<5 then concat('GET /app',user_id%7,'/s',event_id%11,'__redirect__',event_id,'.m3u8 HTTP/1.1')
 when event_id%12<8 then concat('GET /app',user_id%7,'/app',user_id%7,'-s',event_id%11,'-1650000123-',(event_id%5+1)*1000,'.ts HTTP/1.1')
 when event_id%12=8 then concat('GET http://app',user_id%7,'/app',user_id%7,'-s',event_id%11,'-1650000777-',(event_id%5+1)*1000,'.ts HTTP/1.1')
 when event_id%12=9 then concat('GET //app',user_id%7,'//s',event_id%11,'.m3u8 HTTP/1.1')
 when event_id%12=10 then 'GET /broken.ts' else 'GET /favicon.ico HTTP/1.1' end as request_url""",
        """case event_id%7 when 0 then 202 when 1 then 404 when 2 then 500 when 3 then null
 when 4 then 302 else 200 end as http_stat""",
        """concat(cast(floor(value*10) as bigint) div 1000, '.',
 lpad(cast(cast(floor(value*10) as bigint)%1000 as string),3,'0')) as request_time""",
        "(event_id*7919)%100000 as body_bytes_sent",
        """case when event_id%5=0 then 1 when event_id%25=2 then 2 when event_id%5=1 then null
 else 0 end as svr_type""",
        "concat('10.0.0.',event_id%13) as server_addr",
        """case when event_id%5=0 then null when event_id%10=3 then concat('guest',user_id)
 else cast(user_id as string) end as user""",
    )
    record = F.to_json(F.struct(
        "request_url", "http_stat", "request_time", "body_bytes_sent", "svr_type", "server_addr",
        "user", F.col("epoch").cast("string").alias("unix_time"),
    ))
    return fields.select(*_message(HLS_TOPIC, record))


def rtmp_messages(rows):
    """Events -> session-report messages."""
    fields = rows.selectExpr(
        "event_id",
        _EPOCH.replace("as epoch", "as EndTime"),
        "case event_id%4 when 0 then 'forward' when 1 then 'publish' else 'play' end as Cmd",
        "concat('app',user_id%7) as App",
        "concat('s',event_id%11) as Stream",
        "concat('10.1.0.',event_id%13) as SvrIp",
        "case when event_id%3=0 then null else cast(user_id as string) end as User",
        "(event_id*7919)%1000000 as SendByteSum",
        "(event_id*104729)%1000000 as RecvByteSum",
        "(event_id*131)%60000 as PublishTime",
        "(event_id*137)%60000 as PlayTime",
        "event_id%101 as PlayFluency",
        "event_id%97 as PlayFluencyIn60s",
        "event_id%5 as EmptyNumbers",
        "(event_id%5)*40 as EmptyTime",
        "(event_id%5)*25 as MaxEmptyTime",
        "(event_id*17)%900 as FirstBufferTime",
        "event_id%3 as EmptyNumbersIn60s",
        "(event_id%3)*15 as EmptyTimeIn60s",
        "cast((event_id*37)%10001 as double)/100.0D as Max60sFluency",
        "cast((event_id*41)%10001 as double)/100.0D as Min60sFluency",
    )
    names = [c for c in fields.columns if c != "event_id"]
    return fields.select(*_message(RTMP_TOPIC, F.to_json(F.struct(*names))))


def mixed_messages(rows):
    """Both feeds in one frame."""
    return hls_messages(rows).unionByName(rtmp_messages(rows))


def damaged_messages(rows):
    """The access log with broken, trailing, empty and unusable values."""
    n = F.col("offset")
    value = F.col("value")
    return hls_messages(rows).withColumn("value", (
        F.when(n % 17 == 0, F.substring(value, 1, 40))
        .when(n % 19 == 0, F.concat(value, F.lit(" trailing")))
        .when(n % 23 == 0, F.lit(""))
        .when(n % 29 == 0, F.replace(value, F.lit('"request_time":"'), F.lit('"request_time":"?')))
        .when(n % 31 == 0, F.replace(value, F.lit('"unix_time":"'), F.lit('"unix_time":"x')))
        .when(n % 37 == 0, F.concat(F.lit("["), value, F.lit("]")))
        .otherwise(value)
    ))


def wide_hls_messages(rows):
    """The access log with large byte counts and numbers in other spellings."""
    n, value = F.col("offset"), F.col("value")
    size = F.concat(F.lit('"body_bytes_sent":'), (n * 10**12).cast("string"), F.lit(".0"))
    return hls_messages(rows).withColumn("value", (
        F.when(n % 3 == 0, F.regexp_replace(value, '"body_bytes_sent":[0-9]+', size))
        .when(n % 3 == 1, F.regexp_replace(value, '"http_stat":([0-9]+)', '"http_stat":"$1"'))
        .otherwise(F.regexp_replace(value, '"request_time":"[0-9.]+"', '"request_time":"1e3"'))
    ))


def wide_rtmp_messages(rows):
    """Session reports of terabytes, fluency beyond a million, numbers as text."""
    n, value = F.col("offset"), F.col("value")
    size = F.concat(F.lit('"SendByteSum":'), (n * 10**12).cast("string"))
    return rtmp_messages(rows).withColumn("value", (
        F.when(n % 3 == 0, F.regexp_replace(value, '"SendByteSum":[0-9]+', size))
        .when(n % 3 == 1, F.regexp_replace(value, '"PlayFluency":([0-9]+)', '"PlayFluency":"$1000000"'))
        .otherwise(F.regexp_replace(value, '"PublishTime":([0-9]+)', '"PublishTime":$1.0'))
    ))


def damaged_reports(rows):
    """Session reports cut, followed by text, breaking out of an array, without a field."""
    n, value = F.col("offset"), F.col("value")
    return rtmp_messages(rows).withColumn("value", (
        F.when(n % 17 == 0, F.substring(value, 1, 40))
        .when(n % 19 == 0, F.concat(value, F.lit(" trailing")))
        .when(n % 23 == 0, F.concat(value, F.lit('],"y":[1')))
        .when(n % 29 == 0, F.regexp_replace(value, '"Cmd":"[a-z]+",', ""))
        .when(n % 31 == 0, F.regexp_replace(value, '"EndTime":[0-9]+', '"EndTime":"soon"'))
        .when(n % 37 == 0, F.regexp_replace(value, '"PlayTime":[0-9]+', '"PlayTime":"long"'))
        .otherwise(value)
    ))


def mq_pages(rows):
    """Queue pages as JSON text, fifty events to a page."""
    body = (
        F.when(F.col("event_id") % 17 == 0, "junk")
        .when(F.col("event_id") % 10 == 0, F.replace("props", F.lit('"'), F.lit('\\"')))
        .otherwise(F.col("props"))
    )
    entries = rows.select(
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.call_function("div", "event_id", F.lit(50)).alias("page"),
        F.struct("event_id", body.alias("body"), F.col("event_id").alias("offset")).alias("entry"),
    )
    # A page holds at most fifty messages, so the collected list is bounded.
    pages = entries.groupBy("partition", "page").agg(
        F.sort_array(F.collect_list("entry")).alias("entries"),
        (F.max("entry.event_id") + 1).alias("nextOffset"),
    )
    messages = F.transform("entries", lambda e: F.struct(e["body"].alias("body"),
                                                         e["offset"].alias("offset")))
    return pages.select(
        "partition", F.to_json(F.struct("nextOffset", messages.alias("list"))).alias("value")
    )


def mq_offsets(rows):
    """First, committed and last offset of nine queue partitions."""
    return rows.groupBy((F.col("event_id") % 9).cast("int").alias("partition")).agg(
        (F.min("event_id") + 10).alias("startOffset"),
        (F.min("event_id") + F.first(F.col("event_id") % 9) * 7).alias("offset"),
        (F.max("event_id") + 1).alias("lastOffset"),
    )


def geo_ranges(spark, sf_dir):
    """Range table from nations: equal slices of the address space, the top uncovered."""
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        ((F.col("n_nationkey").cast("bigint") + 1) * 161061273 - 1).alias("ip_end"),
        F.col("n_name").alias("location"),
    )


def geo_probes(rows):
    """Events with a dotted-quad client address."""
    ip = (F.col("event_id") * 2654435761) % 4294967296
    octets = [F.call_function("div", ip, F.lit(256**i)) % 256 for i in (3, 2, 1, 0)]
    return rows.select("event_id", F.concat_ws(".", *octets).alias("remote_addr"))
