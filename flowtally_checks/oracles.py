"""The registered queries as SQL over the same tables.

The SQL starts from typed columns of ``events`` and states what each message
means; the Spark side gets there through JSON text.
"""

_HLS = """
typed as (
 select event_id, event_id as "offset", user_id, event_id%12 as kind,
  coalesce(case event_id%7 when 0 then 202 when 1 then 404 when 2 then 500 when 3 then null
   when 4 then 302 else 200 end, 0) as http_stat,
  cast(trunc(cast(concat(cast(cast(floor(value*10) as bigint)//1000 as varchar), '.',
   lpad(cast(cast(floor(value*10) as bigint)%1000 as varchar),3,'0')) as double)*1000) as bigint)
   as request_time,
  (event_id*7919)%100000 as body_bytes_sent,
  case when event_id%5=0 then 1 when event_id%25=2 then 2 else 0 end as svr_type,
  concat('10.0.0.',cast(event_id%13 as varchar)) as server_addr,
  case when event_id%5=0 then 'no_user_keyword'
   when event_id%10=3 then concat('guest',cast(user_id as varchar))
   else cast(user_id as varchar) end as "user",
  cast(strftime(ts + interval 8 hour, '%Y%m%d%H') as bigint) as timestamp_hour,
  cast(strftime(ts + interval 8 hour, '%Y%m%d') as bigint) as day
 from events
),
hls as (
 select *, case when kind<5 or kind=9 then 'm3u8' when kind<9 then 'ts' else 'error' end as hls_type,
  case when kind=10 then 'error' else concat('app',cast(user_id%7 as varchar)) end as app,
  case when kind=10 then 'error' else concat('s',cast(event_id%11 as varchar)) end as stream,
  case when kind between 5 and 8 then cast((event_id%5+1)*1000 as varchar) end as slice,
  case when http_stat>=400 then 1 else 0 end as nlt_400_counts,
  case when request_time>1000 then 1 else 0 end as mt_1_counts,
  case when request_time>3000 then 1 else 0 end as mt_3_counts,
  case when http_stat<400 and http_stat<>202 then body_bytes_sent else 0 end as flux,
  case when http_stat<400 and http_stat<>202 and (
    (kind<5 or kind=9) and request_time<1000
    or kind between 5 and 8 and (event_id%5+1)*1000 > 3*request_time) then 1 else 0 end
   as fluency_counts,
  case when http_stat<400 and http_stat<>202 then 1 else 0 end as valid_counts,
  1 as counts
 from typed where kind<>11
)
"""

_RTMP = """
rtmp as (
 select event_id as "offset",
  case event_id%4 when 0 then 'forward' when 1 then 'publish' else 'play' end as cmd,
  cast(strftime(ts + interval 8 hour, '%Y%m%d%H') as bigint) as timestamp_hour,
  cast(strftime(ts + interval 8 hour, '%Y%m%d') as bigint) as day,
  concat('app',cast(user_id%7 as varchar)) as app, concat('s',cast(event_id%11 as varchar)) as stream,
  case when event_id%3=0 then '-1' else cast(user_id as varchar) end as "user",
  concat('10.1.0.',cast(event_id%13 as varchar)) as svr_ip,
  case when (event_id*131)%60000>=30000 then 1 else 0 end as valid_counts, 1 as total_counts,
  cast(event_id%101 as decimal(18,8)) as play_fluency,
  cast(event_id%97 as decimal(18,8)) as play_fluency_in60s,
  (event_id*131)%60000 as publish_time,
  cast(((event_id*137)%60000)*(event_id%101) as decimal(18,8)) as play_fluency_time,
  event_id%5 as empty_numbers, (event_id%5)*40 as empty_time, (event_id%5)*25 as max_empty_time,
  (event_id*17)%900 as first_buffer_time, event_id%3 as empty_numbers_in60s,
  (event_id%3)*15 as empty_time_in60s,
  case when event_id%101=0 then 1 else 0 end as play_fluency_zero_counts,
  cast(((event_id*37)%10001)/100.0 as decimal(18,8)) as max60s_fluency,
  cast(((event_id*41)%10001)/100.0 as decimal(18,8)) as min60s_fluency,
  case when event_id%4 in (2,3) then (event_id*7919)%1000000 else (event_id*104729)%1000000 end as flux
 from events
)
"""

_HLS_DIMS = ["svr_type", "hls_type", "timestamp_hour", "app", "stream", '"user"', "server_addr",
             "http_stat"]
_HLS_METRICS = ["nlt_400_counts", "mt_1_counts", "mt_3_counts", "flux", "request_time",
                "fluency_counts", "valid_counts", "counts"]
_RTMP_DIMS = ["cmd", "timestamp_hour", "app", "stream", '"user"', "svr_ip"]
_RTMP_WHOLE = ["valid_counts", "total_counts", "publish_time", "empty_numbers", "empty_time",
               "max_empty_time", "first_buffer_time", "empty_numbers_in60s", "empty_time_in60s",
               "play_fluency_zero_counts", "flux"]
_RTMP_FRACTION = ["play_fluency", "play_fluency_in60s", "play_fluency_time", "max60s_fluency",
                  "min60s_fluency"]


def _sum(expression, name):
    return f"cast(sum({expression}) as bigint) as {name}"


def _hls_sums(metrics=tuple(_HLS_METRICS)):
    return ", ".join(_sum(m, m) for m in metrics)


def _rtmp_sums():
    whole = [_sum(m, m) for m in _RTMP_WHOLE]
    return ", ".join(whole + [f"cast(sum({m}) as double) as {m}" for m in _RTMP_FRACTION])


def _quality_sums():
    metrics = ["fluency_counts", "nlt_400_counts", "mt_1_counts", "mt_3_counts", "request_time",
               "counts"]
    split = [_sum(f"case when hls_type<>'ts' then {m} else 0 end", f"{m}_m3") for m in metrics]
    split += [_sum(f"case when hls_type='ts' then {m} else 0 end", f"{m}_ts") for m in metrics]
    return ", ".join([*split, _sum("flux", "flux")])


def _hls(body):
    return f"with {_HLS} {body}"


def _rtmp(body):
    return f"with {_RTMP} {body}"


def _group(source, keys, sums, where="true"):
    """``keys`` maps output name to expression."""
    shown = ", ".join(f"{expression} as {name}" for name, expression in keys.items())
    return f"select {shown}, {sums} from {source} where {where} group by {', '.join(keys.values())}"


def _same(*columns):
    return {c: c for c in columns}


_HLS_BASE = _hls(_group("hls", _same(*_HLS_DIMS), _hls_sums()))
_RTMP_BASE = _rtmp(_group("rtmp", _same(*_RTMP_DIMS), _rtmp_sums()))

# Served tables: filter, time, other keys, counters.
_UP, _DOWN, _DETAIL = "svr_type=1", "svr_type<>1", "svr_type=0"
_PLAY, _FORWARD, _PUBLISH = "cmd='play'", "cmd='forward'", "cmd not in ('play','forward')"
_USER = {'"user"': '"user"'}
_STREAM = _same('"user"', "app", "stream")
_DAY, _HOUR = {'"timestamp"': "day"}, {'"timestamp"': "timestamp_hour"}
_D_HLS = _hls_sums(["flux", "valid_counts", "request_time", "counts", "fluency_counts"])
_D_RTMP = _hls_sums(["flux", "valid_counts", "total_counts"])
_LEGACY = ", ".join([_sum("flux", '"sizeSum"'), _sum("valid_counts", '"count"'),
                     _sum("request_time", '"reqTime"'), _sum("fluency_counts", '"fluency"')])
_UPDATE = {'"updateTime"': "day"}


def _served():
    tables = {}
    for lane, where in (("up", _UP), ("down", _DOWN)):
        tables[f"hls_{lane}"] = _hls(_group("hls", _DAY, _quality_sums(), where))
        tables[f"hls_{lane}_a"] = _hls(
            _group("hls", {**_DAY, **_same("app")}, _quality_sums(), where))
        tables[f"hls_{lane}_s"] = _hls(
            _group("hls", {**_DAY, **_same("server_addr")}, _quality_sums(), where))
    for lane, where in (("up", _UP), ("down", _DETAIL)):
        tables[f"hls_{lane}_user"] = _hls(_group("hls", {**_DAY, **_USER}, _D_HLS, where))
        tables[f"hls_{lane}_user_hour"] = _hls(_group("hls", {**_HOUR, **_USER}, _D_HLS, where))
        tables[f"hls_{lane}_app_stream"] = _hls(_group("hls", {**_DAY, **_STREAM}, _D_HLS, where))
        tables[f"hls_{lane}_app_stream_hour"] = _hls(
            _group("hls", {**_HOUR, **_STREAM}, _D_HLS, where))
        tables[f"hls_{lane}_httpcode"] = _hls(
            _group("hls", {**_DAY, '"httpCode"': "http_stat"}, _D_HLS, where))
    tables["hls_day_data"] = _hls(_group("hls", _UPDATE, _LEGACY, _DETAIL))
    tables["hls_user_data"] = _hls(_group("hls", {**_UPDATE, **_USER}, _LEGACY, _DETAIL))
    tables["hls_stream_data"] = _hls(_group("hls", {**_UPDATE, **_STREAM}, _LEGACY, _DETAIL))
    for lane, where in (("down", _PLAY), ("forward", _FORWARD), ("up", _PUBLISH)):
        tables[f"rtmp_{lane}"] = _rtmp(_group("rtmp", _DAY, _rtmp_sums(), where))
        tables[f"rtmp_{lane}_app"] = _rtmp(
            _group("rtmp", {**_DAY, **_same("app")}, _rtmp_sums(), where))
        tables[f"rtmp_{lane}_server"] = _rtmp(
            _group("rtmp", {**_DAY, **_same("svr_ip")}, _rtmp_sums(), where))
        tables[f"rtmp_{lane}_user"] = _rtmp(_group("rtmp", {**_DAY, **_USER}, _D_RTMP, where))
        tables[f"rtmp_{lane}_user_hour"] = _rtmp(
            _group("rtmp", {**_HOUR, **_USER}, _D_RTMP, where))
        tables[f"rtmp_{lane}_app_stream"] = _rtmp(
            _group("rtmp", {**_DAY, **_STREAM}, _D_RTMP, where))
        tables[f"rtmp_{lane}_app_stream_hour"] = _rtmp(
            _group("rtmp", {**_HOUR, **_STREAM}, _D_RTMP, where))
    return tables


def _cascade():
    few = _hls_sums(["fluency_counts", "valid_counts", "counts"])
    full, kind = _hls_sums(), _same("svr_type", "hls_type")
    hour = _same("timestamp_hour")
    stream = _same("app", "stream", '"user"')
    return {
        "hls_server": _hls(_group(
            "hls", {**_same("svr_type"), **_DAY, **_same("server_addr")}, full)),
        "hls_http_code": _hls(_group("hls", {**_same("svr_type"), **_DAY, **_same("http_stat")}, few)),
        "hls_app_stream_user_hour": _hls(_group("hls", {**kind, **hour, **stream}, full)),
        "hls_app_stream_user": _hls(_group("hls", {**kind, **_DAY, **stream}, full)),
        "hls_app": _hls(_group("hls", {**kind, **_DAY, **_same("app")}, full)),
        "hls_user_hour": _hls(_group("hls", {**kind, **hour, **_USER}, full)),
        "hls_user": _hls(_group("hls", {**kind, **_DAY, **_USER}, full)),
    }


def _levels(source, lanes, columns, levels, sums):
    """One SELECT per level, absent keys NULL."""
    selects = []
    for level, keys in levels.items():
        lane, where = lanes["detail" if level.startswith("detail") else "total"]
        shown = ", ".join(
            f"{name if name in keys else f'cast(null as {kind})'} as {name}"
            for name, kind in columns.items())
        grouped = ", ".join([lane, "day", *[k for k in keys]])
        selects.append(
            f"select {lane} as lane, {shown}, {sums}, '{level}' as level, cast(day as integer) as day"
            f" from {source} where {where} group by {grouped}")
    return " union all ".join(selects)


def _hls_levels():
    source = "(select *, timestamp_hour as hour from hls)"
    lanes = {
        "total": ("case when svr_type=1 then 'up' else 'down' end", "true"),
        "detail": ("case when svr_type=1 then 'up' else 'down' end", "svr_type in (0,1)"),
    }
    columns = {"app": "varchar", "server_addr": "varchar", '"user"': "varchar",
               "stream": "varchar", "http_stat": "integer", "hour": "bigint"}
    levels = {
        "total-day": [], "total-day-app": ["app"], "total-day-server_addr": ["server_addr"],
        "detail-day": [], "detail-day-user": ['"user"'],
        "detail-day-user-app-stream": ['"user"', "app", "stream"],
        "detail-day-http_stat": ["http_stat"], "detail-hour-user": ["hour", '"user"'],
        "detail-hour-user-app-stream": ["hour", '"user"', "app", "stream"],
    }
    sums = f"{_quality_sums()}, {_sum('valid_counts', 'valid_counts')}"
    return _hls(_levels(source, lanes, columns, levels, sums))


def _rtmp_levels():
    source = "(select *, timestamp_hour as hour from rtmp)"
    lane = "case cmd when 'play' then 'down' when 'forward' then 'forward' else 'up' end"
    columns = {"app": "varchar", "svr_ip": "varchar", '"user"': "varchar", "stream": "varchar",
               "hour": "bigint"}
    levels = {
        "total-day": [], "total-day-app": ["app"], "total-day-svr_ip": ["svr_ip"],
        "total-day-user": ['"user"'], "total-day-user-app-stream": ['"user"', "app", "stream"],
        "total-hour-user": ["hour", '"user"'],
        "total-hour-user-app-stream": ["hour", '"user"', "app", "stream"],
    }
    return _rtmp(_levels(source, {"total": (lane, "true")}, columns, levels, _rtmp_sums()))


_UNFOLDED = """
unfolded as (
 select event_id%3 as part, day, "user", min(event_id) as first_offset,
  cast(sum(flux) as bigint) as flux, cast(sum(counts) as bigint) as counts
 from hls where svr_type=0 group by event_id%3, day, "user"
)
"""

_PAGES = """
select cast(event_id%3 as integer) as "partition", event_id as "offset",
 case when event_id%17=0 then 'junk' when event_id%10=0 then replace(props,'"','\\"')
  else props end as body
from events
"""

_OFFSETS = """
offsets as (
 select cast(event_id%9 as integer) as part, min(event_id)+10 as start_offset,
  min(event_id)+(event_id%9)*7 as committed, max(event_id)+1 as last_offset
 from events group by event_id%9
)
"""

_GEO = """
select e.event_id,
 concat_ws('.', cast(e.ip//16777216 as varchar), cast(e.ip//65536%256 as varchar),
  cast(e.ip//256%256 as varchar), cast(e.ip%256 as varchar)) as remote_addr,
 coalesce(r.location,'N/A') as location
from (select event_id, (event_id*2654435761)%4294967296 as ip from events) e
asof left join (select (cast(n_nationkey as bigint)+1)*161061273-1 as ip_end, n_name as location
 from nation) r on e.ip <= r.ip_end
"""

# The same records with other values: what the derivations make of them.
_WIDE_HLS = _HLS.replace("hls as (", "plain as (") + """, changed as (
 select * replace (
  case when event_id%3=0 then cast(event_id as bigint)*1000000000000 else body_bytes_sent end as body_bytes_sent,
  case when event_id%3=2 then 1000000 else request_time end as request_time) from typed
)""" + ", " + _HLS.split("hls as (", 1)[1].join(["wide as (", ""]).replace("from typed", "from changed")
_WIDE_RTMP = _RTMP + """, wide as (
 select * replace (
  case when "offset"%3=0 and cmd='play' then cast("offset" as bigint)*1000000000000 else flux end as flux,
  cast(play_fluency as decimal(30,8))*(case when "offset"%3=1 then 1000000 else 1 end) as play_fluency,
  cast(play_fluency_time as decimal(30,8))*(case when "offset"%3=1 then 1000000 else 1 end) as play_fluency_time)
 from rtmp
)"""

ORACLES = {
    "route_topics": """
select topic, cast(event_id%3 as integer) as "partition", count(*) as n_messages,
 min(event_id) as first_offset, max(event_id) as last_offset
from events, (values ('nodeHls'),('RtmpFluence')) t(topic) group by topic, event_id%3
""",
    "json_quarantine": """
select * from (
 select event_id as "offset",
  case when event_id%17=0 or event_id%19=0 or event_id%23=0 then 'malformed_json'
   when event_id%29=0 then case when event_id%12<>11 then 'bad_request_time' end
   when event_id%31=0 then case when event_id%12<>11 then 'bad_unix_time' end
   when event_id%37=0 then 'malformed_json'
   when event_id%12<>11 then 'accepted' end as verdict
 from events) where verdict is not null
""",
    "mq_explode": _PAGES,
    "mq_normalise": """
select cast(event_id%3 as integer) as "partition", event_id as "offset",
 case when event_id%17<>0 then cast(json(props) as varchar) end as value,
 case when event_id%17<>0 then cast(json_extract(props,'$.k') as bigint) end as k,
 case when event_id%17=0 then 'malformed_json' end as reject
from events
""",
    "archive_by_day": """
select topic, cast(strftime(ts + interval 8 hour, '%Y%m%d') as bigint) as day,
 count(*) as n_messages
from events, (values ('nodeHls'),('RtmpFluence')) t(topic) group by 1, 2
""",
    "replay_day": _hls(_group("hls", _same(*_HLS_DIMS), _hls_sums(), "day=20240115")),
    "stream_hls_partials": _HLS_BASE,
    "stream_rtmp_partials": _RTMP_BASE,
    "served_after_stream": _served()["hls_down_app_stream_hour"],
    "handoff_hls": _served()["hls_down_a"],
    "handoff_rtmp": _served()["rtmp_down"],
    "fold_hls": _HLS_BASE,
    "fold_rtmp": _RTMP_BASE,
    "hls_wide_values": f"""with {_WIDE_HLS} """ + _group(
        "wide", {**_DAY, **_same("app")}, _quality_sums(), _DOWN),
    "rtmp_wide_values": f"""with {_WIDE_RTMP} """ + _group(
        "wide", {**_DAY, **_same("app")}, _rtmp_sums(), _PLAY),
    "json_quarantine_rtmp": """
select event_id as "offset",
 case when event_id%17=0 or event_id%19=0 or event_id%23=0 then 'malformed_json'
  when event_id%29=0 then 'missing_field' when event_id%31=0 then 'bad_end_time'
  when event_id%37=0 then 'bad_metric' else 'accepted' end as verdict
from events
""",
    "archive_stream_by_day": """
select topic, cast(strftime(ts + interval 8 hour, '%Y%m%d') as bigint) as day,
 count(*) as n_messages
from events, (values ('nodeHls'),('RtmpFluence')) t(topic) group by 1, 2
""",
    "replay_streamed_day": _hls(_group("hls", _same(*_HLS_DIMS), _hls_sums(), "day=20240115")),
    "stream_rewritten_batch": _HLS_BASE,
    "serve_hls": _served()["hls_down_app_stream"],
    "serve_rtmp": _served()["rtmp_down_app"],
    "serve_rewritten_batch_hls": _served()["hls_down_a"],
    "serve_rewritten_batch_rtmp": _served()["rtmp_down"],
    "compacted_day": _hls(_group("hls", _same(*_HLS_DIMS), _hls_sums(), "day=20240115")),
    "serve_deltas": _hls(_group("hls", {**_HOUR, **_USER}, _D_HLS, f"{_DETAIL} and day<>20240115")),
    "replay_sealed_day": f"""
with {_HLS} select 'nodeHls' as topic, cast(event_id%3 as integer) as "partition", event_id as "offset",
 body_bytes_sent as bytes from typed where day=20240115
""",
    "partition_progress_indexed": f"""
with {_OFFSETS} select part as "partition", committed, min(event_id) as "offset",
 arg_min(cast(strftime(ts + interval 8 hour, '%Y%m%d') as bigint), event_id) as day
from events join offsets on event_id%9=part where event_id>=committed group by part, committed
""",
    "intake_both_feeds": f"""
with {_HLS}, {_RTMP} select 'hls' as name, day, count(*) as n from hls group by day
union all select 'rtmp', day, count(*) from rtmp group by day
union all select 'lines-' || topic, day, count(*) from typed, (values ('nodeHls'),('RtmpFluence')) t(topic) group by topic, day
""",
    "mq_stream": f"""
with pages as ({_PAGES}), starts as (select event_id%3 as part, min(event_id)+10 as first from events group by 1)
select p."partition", p."offset", p.body from pages p join starts s on p."partition"=s.part where p."offset">=s.first
""",
    "mq_next_position": """
select cast(event_id%3 as integer) as "partition", max(event_id)+1 as "nextOffset"
from events group by event_id%3
""",
    "partition_progress_rtmp": f"""
with {_OFFSETS} select part as "partition", committed, min(event_id) as "offset",
 arg_min(cast(strftime(ts + interval 8 hour, '%Y%m%d') as bigint), event_id) as day
from events join offsets on event_id%9=part where event_id>=committed group by part, committed
""",
    "partition_lag": f"""
with {_OFFSETS} select part as "partition", start_offset as "startOffset",
 last_offset as "lastOffset", greatest(committed,start_offset) as "offset",
 committed<start_offset as clamped,
 greatest(last_offset-greatest(committed,start_offset),0) as backlog,
 greatest(committed,start_offset)<last_offset as has_new
from offsets
""",
    "partition_progress": f"""
with {_OFFSETS} select part as "partition", committed, min(event_id) as "offset",
 arg_min(cast(strftime(ts + interval 8 hour, '%Y%m%d') as bigint), event_id) as day
from events join offsets on event_id%9=part where event_id>=committed group by part, committed
""",
    "rollup_unique_check": f"""
with {_HLS}, {_UNFOLDED} select day as "timestamp", "user", count(*) as n_rows from unfolded
group by day, "user" having count(*)>1
""",
    "rollup_dedup": f"""
with {_HLS}, {_UNFOLDED} select cast(part as integer) as "partition", day as "timestamp", "user",
 first_offset, flux, counts
from unfolded qualify row_number() over (partition by day, "user" order by first_offset)=1
""",
    "purge_day": " union all ".join(
        f"""select '{name}' as name, "{time}" as "timestamp", count(*) as n_rows,
 cast(sum("{flux}") as bigint) as flux from ({sql}) where cast("{time}" as varchar) not like '20240115%'
 group by "{time}" """
        for name, sql in _served().items()
        for time, flux in [("updateTime", "sizeSum") if "updateTime" in sql else ("timestamp", "flux")]),
    "stored_key_check": " union all ".join(
        f"select '{name}' as name, count(*) as n_rows, count(*) as n_keys from ({sql})"
        for name, sql in _served().items()),
    "hls_valid_filter": """
select event_id as "offset",
 case when event_id%12<5 then concat('GET /app',cast(user_id%7 as varchar),'/s',cast(event_id%11 as varchar),'__redirect__',cast(event_id as varchar),'.m3u8 HTTP/1.1')
 when event_id%12<8 then concat('GET /app',cast(user_id%7 as varchar),'/app',cast(user_id%7 as varchar),'-s',cast(event_id%11 as varchar),'-1650000123-',cast((event_id%5+1)*1000 as varchar),'.ts HTTP/1.1')
 when event_id%12=8 then concat('GET http://app',cast(user_id%7 as varchar),'/app',cast(user_id%7 as varchar),'-s',cast(event_id%11 as varchar),'-1650000777-',cast((event_id%5+1)*1000 as varchar),'.ts HTTP/1.1')
 when event_id%12=9 then concat('GET //app',cast(user_id%7 as varchar),'//s',cast(event_id%11 as varchar),'.m3u8 HTTP/1.1')
 else 'GET /broken.ts' end as request_url
from events where event_id%12<>11
""",
    "hls_url_parse": _hls('select "offset", hls_type, app, stream, slice from hls'),
    "hls_flags": _hls('select "offset", svr_type, http_stat, ' + ", ".join(
        f"cast({m} as bigint) as {m}" for m in _HLS_METRICS) + " from hls"),
    "hls_user_normalise": _hls('select "offset", "user" from hls'),
    "hls_time_keys": _hls('select "offset", timestamp_hour, day as "timestamp" from hls'),
    "hls_base": _HLS_BASE,
    "rtmp_derive": _rtmp('select "offset", ' + ", ".join(
        [*_RTMP_DIMS, *[f"cast({m} as bigint) as {m}" for m in _RTMP_WHOLE],
         *[f"cast({m} as double) as {m}" for m in _RTMP_FRACTION]]) + " from rtmp"),
    "rtmp_base": _RTMP_BASE,
    **_cascade(),
    **_served(),
    "hls_all_levels": _hls_levels(),
    "rtmp_all_levels": _rtmp_levels(),
    "rtmp_app_stream": _rtmp(_group(
        "rtmp", {**_DAY, **_same("app", "stream")}, _D_RTMP, _PLAY)),
    "geo_lookup": _GEO,
    "geo_lookup_16": _GEO,
    "geo_lookup_shuffled": _GEO,
}
