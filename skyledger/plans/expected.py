"""The registered queries in plain SQL, written apart from the library's own code."""

from __future__ import annotations

from skyledger.plans.feed import FEED

_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%gZ')"
_FEED = f"feed as ({FEED.format(events='events')})"
_KNOWN = (
    "'TAKEOFF','LANDING','DELIVERY_COMPLETED','DELIVERY_FAILED','ROUTE_ADJUSTED','SENSOR_READING',"
    "'BATTERY_LOW','BATTERY_CRITICAL','MOTOR_FAULT','GPS_SIGNAL_LOST'"
)
_TYPE = (
    "case when upper(regexp_replace(trim(event_type_raw), '[ -]+', '_', 'g')) in (" + _KNOWN + ") "
    "then upper(regexp_replace(trim(event_type_raw), '[ -]+', '_', 'g')) else 'UNKNOWN' end"
)
_TIME = (
    "case when regexp_full_match(timestamp_text, '[0-9]+') "
    "then make_timestamp(try_cast(timestamp_text as bigint) * 1000000) "
    "else date_trunc('millisecond', try_cast(timestamp_text as timestamp)) end"
)
_SEVERITY = (
    "case when event_type in ('DELIVERY_FAILED','MOTOR_FAULT','GPS_SIGNAL_LOST','BATTERY_CRITICAL') then 'error' "
    "when status_code >= 500 then 'error' when status_code >= 400 then 'warning' "
    "when event_type in ('BATTERY_LOW','ROUTE_ADJUSTED') then 'warning' "
    "when battery_pct <= 15 then 'warning' else 'info' end"
)
_NUMBER = "regexp_replace(cast({0} as varchar), '\\.0$', '')"
_CSV_NOTE = "case when seq % 17 = 0 then 'two' || chr(10) || 'lines, \"' || seq || '\"' else 'n' || seq end"


def _judged(resent: bool = True) -> str:
    """CTEs ending in ``judged``: every delivered record with its verdict."""
    again = """
      union all
      select *, cast(floor(seq / 500) as bigint) + case when seq % 2 = 0 then 0 else 1000000000 end, seq + 1000000000
      from feed where seq % 97 = 0"""
    return f"""{_FEED},
    sent as (
      select *, cast(floor(seq / 500) as bigint) as batch_seq, seq as pos from feed{again if resent else ''}),
    typed as (
      select *, 'm' || batch_seq as batch_id, 'sqs:m' || batch_seq || '#' || pos as source,
        {_TIME} as event_time, {_TYPE} as event_type,
        try_cast(nullif(status_text, '') as integer) as status_code,
        '{{"batteryPct":' || {_NUMBER.format('battery_pct')} || ',"k":' || regexp_extract(props, '[0-9]+') || ',"lat":'
          || lat || ',"lon":' || lon || ',"motor":{{"rpm":[' || rpm || ',true,null],"é":"x"}}}}' as telemetry,
        not (broken or drone_id = '' or ({_TIME}) is null or trim(event_type_raw) = ''
             or status_text = 'abc' or battery_pct > 100 or lat > 90 or lon < -180) as valid
      from sent),
    judged as (
      select *, {_SEVERITY} as severity,
        case when valid then coalesce(supplied_id, substring(sha256(drone_id || '|' || {_ISO.format('event_time')}
          || '|' || event_type || '|' || coalesce(cast(status_code as varchar), '') || '|' || telemetry), 1, 32)) end
          as event_id
      from typed)"""


_J = _judged()
_WINNERS = (
    _J + ", winners as (select * from judged where valid "
    "qualify row_number() over (partition by event_id order by batch_seq, pos) = 1)"
)
_ISSUES = (
    _J + """, issues as (
      select batch_id, pos, '(root)' as path, 'parse_error' as code,
        'invalid JSON: the text is not one JSON value' as message from judged where broken
      union all select batch_id, pos, 'droneId', 'too_small', 'droneId must not be empty'
        from judged where not broken and drone_id = ''
      union all select batch_id, pos, 'timestamp', 'invalid_type',
        'timestamp must be an ISO 8601 date or an epoch value' from judged where not broken and event_time is null
      union all select batch_id, pos, 'eventType', 'invalid_type', 'eventType is required'
        from judged where not broken and trim(event_type_raw) = ''
      union all select batch_id, pos, 'statusCode', 'invalid_type',
        'Invalid input: expected number, received string' from judged where not broken and status_text = 'abc'
      union all select batch_id, pos, 'telemetryData.batteryPct', 'too_big', 'batteryPct must be between 0 and 100'
        from judged where not broken and battery_pct > 100
      union all select batch_id, pos, 'telemetryData.lat', 'too_big', 'lat must be between -90 and 90'
        from judged where not broken and lat > 90
      union all select batch_id, pos, 'telemetryData.lon', 'too_small', 'Too small: expected number to be >=-180'
        from judged where not broken and lon < -180)"""
)
_EVENT_COLUMNS = (
    f"event_id, drone_id, {_ISO.format('event_time')} as event_time, event_type, status_code, severity, "
    "battery_pct, cast(lat as double) as latitude, cast(lon as double) as longitude, telemetry"
)
_COUNTERS = (
    _J + """, counters as (
      select batch_id, count(*) as received, count(distinct event_id) as valid,
        count(*) filter (not valid) as quarantined,
        count(*) filter (valid) - count(distinct event_id) as duplicates_in_batch,
        count(distinct event_id) = 0 as contract_smell
      from judged group by batch_id)"""
)
_OVERLAP = (
    _WINNERS + ", stored as (select distinct event_id from judged "
    "where valid and try_cast(substring(drone_id, 7, 3) as integer) % 3 = 0)"
)
_CLOCK = "make_timestamp((1704067200 + (pos % 1000000) * 10) * 1000000)"
_ATTEMPTS = (
    "attempts as (select 'm' || cast(floor(event_id / 4) as bigint) as batch_id, "
    "event_type in ('error', 'view') as failed, ts from events)"
)
_DEAD = (
    _ATTEMPTS + ", dead as (select batch_id, count(*) filter (failed) as failures, max(ts) as last_attempt "
    "from attempts group by batch_id having count(*) filter (failed) >= 3 and bool_and(failed))"
)
#: The text of a record as received.
_TELEMETRY_TEXT = (
    "'{\"batteryPct\":' || cast(battery_pct as varchar) || ',\"lat\":' || lat || ',\"lon\":\"' || lon || "
    "'\",\"motor\":{\"é\":\"x\",\"rpm\":[' || rpm || ',true,null]},' || substring(props, 2)"
)
_PAYLOAD = (
    "'{' || coalesce('\"eventId\":\"' || supplied_id || '\",', '') || '\"droneId\":\"' || drone_id || '\",\"timestamp\":\"' || timestamp_text "
    "|| '\",\"eventType\":\"' || event_type_raw || '\",\"statusCode\":\"' || status_text || '\",\"telemetryData\":' "
    f"|| case when embedded then '\"' || replace({_TELEMETRY_TEXT}, '\"', '\\\"') || '\"' else {_TELEMETRY_TEXT} end || '}}'"
)
_BODIES = _FEED + ", bodies as (select *, 'm' || seq as message_id, seq % 8 as shape from feed)"


def oracle_sql() -> dict[str, str]:
    sql = {
        "q_severity": f"""with {_FEED}, typed as (select seq, battery_pct, {_TYPE} as event_type,
            try_cast(nullif(status_text, '') as integer) as status_code from feed)
            select seq, event_type, status_code, {_SEVERITY} as severity from typed""",
        "q_timestamp_coerce": f"""with {_FEED}, timed as (select seq, {_TIME} as t from feed)
            select seq, {_ISO.format('t')} as event_time, t < timestamp '2020-01-01' as too_old,
              t > timestamp '2024-01-21' as too_new from timed""",
        "q_numeric_coerce": """with n as (select event_id as seq, case event_id % 9
              when 0 then cast(event_id as double) when 1 then event_id + 0.5 when 2 then power(10, event_id % 5)
              when 5 then cast('0.' || event_id as double) when 6 then event_id when 8 then event_id end as number
            from events)
            select seq, cast(number as double) as number, number = floor(number) as whole,
              number between 0 and 100 as in_range from n""",
        "q_event_type": f"""with {_FEED} select case when trim(event_type_raw) <> '' then {_TYPE} end as event_type,
            count(*) as n from feed group by 1""",
        "q_canonical_json": f"""select event_id as seq, '{{"e":' || event_id * 1000 || ',"t":"1e5","v":'
            || {_NUMBER.format('value')} || ',"z":{{"a":[true,false,"007"],"b":' || event_id || '}}}}' as canonical
            from events""",
        "q_url_decode": """select event_id as seq, '2024/' || event_type || ' batch ' || event_id || ' é.csv'
            as object_key from events""",
        "q_validate_issues": f"with {_ISSUES} select * from issues",
        "q_event_id": f"""with {_J} select batch_id, pos, event_id,
            case when supplied_id is null then 'derived' else 'supplied' end as id_kind, drone_id,
            {_ISO.format('event_time')} as event_time, event_type, status_code, severity, battery_pct,
            cast(lat as double) as latitude, cast(lon as double) as longitude, telemetry from judged where valid""",
        "q_dedup_in_batch": f"""with {_J} select batch_id, event_id, pos from judged where valid
            qualify row_number() over (partition by batch_id, event_id order by pos) = 1""",
        "q_first_wins": f"with {_WINNERS} select event_id, batch_id, source from winners",
        "q_insert_if_absent": f"""with {_OVERLAP} select event_id, batch_id, drone_id from winners w
            where not exists (select 1 from stored s where s.event_id = w.event_id)""",
        "q_redeliveries": f"""with {_OVERLAP} select event_id, batch_id, drone_id from winners w
            where exists (select 1 from stored s where s.event_id = w.event_id)""",
        "q_batch_counters": f"with {_COUNTERS} select * from counters",
        "q_outcomes": f"""with {_COUNTERS}, winners as (select * from judged where valid
              qualify row_number() over (partition by event_id order by batch_seq, pos) = 1),
            inserted as (select batch_id, count(*) as inserted from winners group by batch_id)
            select c.batch_id, 'processed' as status, received, valid, coalesce(inserted, 0) as inserted,
              valid - coalesce(inserted, 0) as duplicates, duplicates_in_batch, quarantined, contract_smell
            from counters c left join inserted i on c.batch_id = i.batch_id""",
        "q_dead_letters": f"""with {_DEAD} select batch_id, failures, {_ISO.format('last_attempt')} as last_attempt
            from dead""",
        "q_dead_letter_alarm": f"""with {_DEAD} select {_ISO.format("time_bucket(interval '1 hour', last_attempt)")}
            as window_start, count(*) as dead_letters from dead group by 1""",
        "q_alarm_windows": f"""with {_ATTEMPTS}, w as (select time_bucket(interval '1 hour', ts) as t,
              count(*) filter (failed) as failures from attempts group by 1),
            runs as (select t, failures, lag(failures) over (order by t) as b, lag(t) over (order by t) as b_t from w)
            select {_ISO.format('t')} as window_start, failures, b as failures_1_before from runs
            where failures > 5 and b > 5 and b_t = t - interval '1 hour'""",
        "q_device_events": f"""with {_WINNERS} select {_EVENT_COLUMNS} from winners where drone_id = 'DRONE-042'
            order by winners.event_time desc, event_id desc limit 20""",
        "q_device_events_page2": f"""with {_WINNERS} select {_EVENT_COLUMNS} from winners where drone_id = 'DRONE-042'
            and (winners.event_time, event_id) < (timestamp '2024-01-15', '~')
            order by winners.event_time desc, event_id desc limit 20""",
        "q_errors_window": f"""with {_WINNERS} select {_EVENT_COLUMNS} from winners where severity = 'error'
            and winners.event_time >= timestamp '2024-01-10' and winners.event_time < timestamp '2024-01-20'
            order by winners.event_time desc, event_id desc limit 100""",
        "q_cursors": f"""with {_WINNERS} select event_id, replace(translate(base64(encode(
            {_ISO.format('event_time')} || '|' || event_id)), '+/', '-_'), '=', '') as next_cursor from winners""",
        "q_quarantine_latest": f"""with {_ISSUES}, n as (select batch_id, pos, count(*) as n_errors from issues group by all)
            select j.source, {_ISO.format(_CLOCK.replace('pos', 'j.pos'))} as failed_at, cast(n.n_errors as integer) as n_errors
            from judged j join n on j.batch_id = n.batch_id and j.pos = n.pos
            order by {_CLOCK.replace('pos', 'j.pos')} desc, j.source desc limit 50""",
        "q_containment": f"""with {_WINNERS} select event_id, telemetry from winners
            where cast(json_extract(telemetry, '$.k') as bigint) = 7""",
        "q_containment_nested": f"with {_WINNERS} select event_id, telemetry from winners where rpm = 3",
        "q_containment_indexed": f"with {_WINNERS} select event_id, telemetry from winners where rpm = 3",
        "q_redelivered_outcomes": f"""with {_judged(resent=False)}, twice as (
              select 'm' || seq as message_id, 0 as again, * from judged
              union all select 'm' || seq, 1, * from judged where seq % 3 = 0),
            placed as (select *, valid and row_number() over (partition by event_id order by again, message_id) = 1 as won
              from twice)
            select message_id as batch_id, again as delivery, 1 as received, cast(valid as bigint) as valid,
              cast(won as bigint) as inserted, cast(valid and not won as bigint) as duplicates,
              0 as duplicates_in_batch, cast(not valid as bigint) as quarantined from placed""",
        "q_stream_retry": f"""with {_judged(resent=False)} select count(*) as received,
            count(distinct event_id) as inserted, 3 + count(distinct floor(seq / 4096)) filter (floor(seq / 4096) % 2 = 1)
            as failures, 1 as dead, count(distinct event_id) as events from judged""",
        "q_record_cap": f"""with {_FEED}, f as (select cast(floor(seq / 4096) as bigint) as chunk, count(*) as n
              from feed group by 1) select cast(sum(least(n, 1000)) as bigint) as received,
              cast(sum(greatest(n - 1000, 0)) as bigint) as truncated from f""",
        "q_file_stream": f"""with {_judged(resent=False)} select severity, count(distinct event_id) as events,
            count(distinct event_id) as ids, cast(sum(coalesce(status_code, 0)) as bigint) as status_sum
            from judged where valid group by severity""",
        "q_outcome_rate": f"""with {_COUNTERS} select {_ISO.format("timestamp '2026-12-01'")} as window_start,
            cast(sum(received) as bigint) as received, cast(sum(quarantined) as bigint) as quarantined,
            round(sum(quarantined) / sum(received), 6) as rate from counters""",
        "q_event_count": f"with {_WINNERS} select count(*) as n from winners",
        "q_failing_fields": f"with {_ISSUES} select path, count(*) as n from issues group by path",
        "q_battery_altitude": f"""with {_WINNERS}, r as (select drone_id, battery_pct as b,
              cast(json_extract(telemetry, '$.k') as double) as a from winners)
            select drone_id, count(*) as readings, case when count(*) > 2 then round(corr(b, a), 6) end as correlation,
              case when count(*) > 2 then round(regr_slope(b, a), 6) end as slope, round(avg(b), 6) as avg_battery,
              min(b) as min_battery, max(b) as max_battery from r group by drone_id""",
        "q_quarantine_rate": f"""with {_J} select {_ISO.format(f"time_bucket(interval '5 minutes', {_CLOCK})")}
            as window_start, count(*) as received, count(*) filter (not valid) as quarantined,
            round(count(*) filter (not valid) / count(*), 6) as rate from judged group by 1""",
        "q_error_share": f"""with {_WINNERS} select strftime(event_time, '%Y-%m-%d') as day, count(*) as events,
            count(*) filter (severity = 'error') as errors,
            round(count(*) filter (severity = 'error') / count(*), 6) as share from winners group by 1""",
        "q_csv_rows": f"""with {_FEED}, r as (select *, cast(floor(seq / 4096) as bigint) as chunk from feed)
            select chunk, cast(1 + row_number() over w + coalesce(sum(case when seq % 17 = 0 and not broken then 1 else 0 end)
                over (w rows between unbounded preceding and 1 preceding), 0) as bigint) as line,
              case when not broken then drone_id end as drone_id,
              case when not broken then battery_pct end as battery_pct,
              case when not broken then {_CSV_NOTE} end as note,
              case when broken then 'malformed CSV row: expected 6 columns, found 2' end as parse_error
            from r window w as (partition by chunk order by seq)""",
        "q_ndjson_rows": f"""with {_FEED}, r as (select *, cast(floor(seq / 4096) as bigint) as chunk from feed)
            select chunk, cast(row_number() over w + sum(case when seq % 19 = 0 then 1 else 0 end)
                over (w rows between unbounded preceding and current row) as bigint) as line,
              case when not broken then drone_id end as drone_id, broken as rejected
            from r window w as (partition by chunk order by seq)""",
        "q_json_rows": f"""with {_FEED}, d as (select *, cast(floor(seq / 20) as bigint) as doc,
              bool_or(broken) over (partition by floor(seq / 20)) as bad from feed)
            select 'doc-' || doc || '#' || (row_number() over (partition by doc order by seq) - 1) as source, drone_id,
              'object' as root_kind, false as rejected from d where not bad
            union all select distinct 'doc-' || doc, cast(null as varchar), cast(null as varchar), true from d where bad""",
        "q_formats": """select 'f' || event_id as file, case event_id % 4 when 0 then 'ndjson' when 1 then 'json'
            when 2 then 'json' else 'csv' end as format from events""",
        "q_messages": f"""with {_BODIES}
            select message_id as batch_id, 'sqs:' || message_id as source, cast(null as varchar) as drone_id,
              'none' as root_kind, 'message body is not valid JSON' as parse_error
            from bodies where shape = 4 or (broken and shape not in (2, 3))
            union all select message_id, 'sqs:' || message_id || case when shape = 0 then '#0' else '' end, drone_id,
              'object', null from bodies where not broken and shape not in (2, 3, 4)
            union all select message_id, 'sqs:' || message_id || '#1', null, 'number', null
            from bodies where not broken and shape = 0""",
        "q_notices": f"""with {_BODIES}
            select message_id, 0 as entry_pos, 'raw' as bucket, 'd/' || seq || ' a.csv' as key,
              's3a://raw/d/' || seq || ' a.csv' as path from bodies where shape = 2
            union all select message_id, 1, 'raw', 'b.csv', 's3a://raw/b.csv' from bodies where shape = 2""",
        "q_message_roles": f"""with {_BODIES} select case when shape = 2 then 'notice' when shape = 3 then 'test'
            when shape = 4 or broken then 'rejected' else 'records' end as role, count(*) as n from bodies group by 1""",
        "q_intake_replay": f"""with {_judged(resent=False)}, c as (select count(*) as received,
              count(distinct event_id) as valid, count(*) filter (valid) - count(distinct event_id) as again,
              count(*) filter (not valid) as quarantined from judged)
            select 'load-1' as batch_id, received, valid, valid as inserted, 0 as duplicates,
              again as duplicates_in_batch, quarantined from c
            union all select 'load-2', received, valid, 0, valid, again, quarantined from c""",
        "q_alarm_stream": f"""with {_ATTEMPTS}, w as (select time_bucket(interval '1 hour', ts) as t from attempts group by 1
              having count(*) filter (failed) > 5),
            r as (select t, t - row_number() over (order by t) * interval '1 hour' as run from w),
            g as (select min(t) as t from r group by run having count(*) >= 2)
            select {_ISO.format('t')} as run_start, {_ISO.format("t + interval '1 hour'")} as window_start from g""",
        "q_device_dates": f"""with {_WINNERS} select {_EVENT_COLUMNS} from winners where drone_id = 'DRONE-042'
            order by winners.event_time desc, event_id desc limit 20""",
        "q_device_walk": f"""with {_WINNERS}, w as (select event_id, cast(row_number() over (order by event_time desc, event_id desc) - 1
              as integer) as n from winners where drone_id = 'DRONE-042')
            select n // 100 as page, n % 100 as place, event_id from w""",
        "q_quarantine_stored": f"""with {_J}, i as ({_ISSUES.removeprefix(_J).removeprefix(', issues as (').rstrip()[:-1]}),
            n as (select batch_id, pos, count(*) as n_errors from i group by batch_id, pos), p as (select *, {_PAYLOAD} as whole from judged where not valid)
            select source, case when broken then left(whole, 20) else whole end as raw_payload, cast(n_errors as integer) as n_errors
            from p join n using (batch_id, pos) order by source desc, raw_payload desc limit 200""",
        "q_sample_errors": f"""with {_ISSUES}, o as (select pos, path || ':' || code as line,
              case path when 'droneId' then 1 when 'timestamp' then 2 when 'eventType' then 3 when 'statusCode' then 4
                when 'telemetryData.batteryPct' then 5 when 'telemetryData.lat' then 6 when 'telemetryData.lon' then 7 else 0 end as place from issues)
            select 'e' || pos as batch_id, string_agg(line, ',' order by place) as sample from o group by pos""",
        "q_json_pieces": f"""with {_FEED}, r as (select *, cast(floor(seq / 4096) as bigint) as chunk from feed where not broken)
            select chunk, row_number() over (partition by chunk order by seq) - 1 as pos, drone_id, status_text, 'object' as root_kind from r""",
        "q_insert_supplied": f"""with {_WINNERS}, m as (select event_id, case when supplied_id is null then 'derived' else 'supplied' end as id_kind,
              case when try_cast(substring(drone_id, 7, 3) as integer) % 2 = 0 then 'half' else 'all' end as ingest_batch from winners)
            select ingest_batch, id_kind, count(*) as events, count(distinct event_id) as ids from m group by ingest_batch, id_kind""",
        "q_batch_breaks": f"""with {_J}, c as (select count(distinct event_id) as events, count(*) filter (not valid) as quarantined from judged)
            select 'broken' as state, events, 0 as quarantined from c union all select 'again', events, quarantined from c""",
        "q_replay_resumes": f"""with {_judged(resent=False)}, c as (select count(*) as received, count(distinct event_id) as inserted,
              count(*) filter (not valid) as quarantined from judged)
            select state, received, inserted, quarantined, true as "any" from c, (values ('resumed'), ('done')) as s(state)""",
        "q_timed_retry": f"""with {_judged(resent=False)} select cast(ceil(count(distinct seq % 12) / 3) as bigint) as notices, count(*) as received,
            count(distinct event_id) as inserted, 1 as dead, count(distinct event_id) as events from judged""",
        "q_stream_intake": f"""with {_WINNERS} select severity, count(*) as events, count(distinct event_id) as ids,
            cast(sum(coalesce(status_code, 0)) as bigint) as status_sum from winners group by severity""",
    }
    # The same answers, from kept sums.
    for name in ("failing_fields", "error_share"):
        sql[f"q_kept_{name}"] = sql[f"q_{name}"]
    sql["q_kept_battery"] = sql["q_battery_altitude"]
    return {name: " ".join(text.split("\n")) for name, text in sql.items()}
