"""What each registered query must return, in DuckDB SQL over the given tables.

Written from the meaning of the queries, not from their code: flattened spans
are computed from the orders without any JSON, upserts are spelled out as joins,
and "latest value" picks the first of an ordered list.
"""

import re

from checks import fixtures as fx

_IN = f"t between timestamp '{fx.START}' and timestamp '{fx.END}'"


def _pattern(text: str) -> str:
    line = rf"trim(split_part({text}, chr(10), 1), ' ' || chr(13) || chr(10) || chr(9))"
    return _normalized(line)


def _normalized(text: str) -> str:
    iso = r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([+-]\d{2}:\d{2}|Z)?"
    uuid = r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
    out = text
    for regex, token in ((iso, "{timestamp}"), (uuid, "{uuid}"), ("0x[0-9a-fA-F]+", "{hex}"), ("[0-9]+", "{n}")):
        out = f"regexp_replace({out}, '{regex}', '{token}', 'g')"
    return out


_PREFIX = """case when event_action like 'content.cobrand._%' or event_action = 'content.cobrand.' then 'content.cobrand'
  else regexp_extract(event_action, '^[^.]*') end"""

_SIGNATURE = """case when raw_pattern ilike '%ffprobe exited%' then 'FFPROBE_INVALID_MEDIA'
 when raw_pattern ilike '%moov atom not found%' then 'INVALID_MP4_CONTAINER'
 when raw_pattern ilike '%max fps%' then 'VIDEO_MAX_FPS_TOO_LOW'
 when raw_pattern ilike '%couldn''t find a single max width or height%' then 'IMAGE_DIMENSIONS_NOT_FOUND'
 when raw_pattern ilike '%twitter token validation failed%' or raw_pattern ilike '%twitter token refresh failed%' then 'TWITTER_TOKEN_INVALID'
 when raw_pattern ilike '%cobrand is still in progress%' then 'COBRAND_PENDING'
 when raw_pattern ilike '%scheduled post media is not ready yet%' then 'MEDIA_NOT_READY'
 else raw_pattern end"""


def _time(comma: str) -> str:
    """12-hour reading where the mark fits the hour, else the text without its mark as 24-hour."""
    return (
        f"coalesce(try_strptime(event_time, '%a, %d %b %Y{comma} %I:%M:%S %p'), "
        f"try_strptime(left(event_time, -3), '%a, %d %b %Y{comma} %H:%M:%S'))"
    )


def _last(value: str, time: str = "t") -> str:
    """The value of the latest row that has value and time; the greatest among equals."""
    return f"list({value} order by {time} desc, {value} desc) filter (where {value} is not null and {time} is not null)[1]"


_TS = "timestamp "

_CTES = {
    "api_log": fx.sql(fx.API_LOG, "duckdb"),
    "api": f"select *, {_time('')} as t from api_log",
    "spans0": fx.sql(fx.SPANS, "duckdb"),
    "spans": f"select *, {_time(',')} as t from spans0",
    "cob0": fx.sql(fx.COBRAND_EVENTS, "duckdb"),
    "cob": f"select *, {_time(',')} as t from cob0",
    # registry
    "prefixes": f"select distinct {_PREFIX} as prefix from api_log where event_action is not null",
    "cap_state": fx.CAPABILITY_STATE.replace("{P}", "prefixes").replace("as {TS})", "as timestamp)").replace("{TS}", _TS),
    "cap_meta": f"""select {_PREFIX} as event_prefix, min(t) as first_seen, max(t) as last_seen, count(*) as event_count,
        {_last('event_action')} as sample_event, {_last('service_name')} as sample_service
        from api where event_action is not null group by 1""",
    "cap": """select coalesce(s.event_prefix, m.event_prefix) as event_prefix, s.capability, s.subsystem, s.description,
        case when m.event_prefix is null then s.classification_status else coalesce(s.classification_status, 'Pending') end as classification_status,
        least(s.first_seen, m.first_seen) as first_seen,
        case when m.event_prefix is null then s.last_seen else m.last_seen end as last_seen,
        case when m.event_prefix is null then s.event_count else m.event_count end as event_count,
        m.sample_event, m.sample_service
        from cap_state s full join cap_meta m on s.event_prefix = m.event_prefix""",
    # gaps
    "gap_src": """select 'API' as source_system, message, service_name, level as log_level, t as parsed_event_time
        from api where event_action is null and message is not null
        union all select 'COBRAND', message, coalesce(service_name, 'cobrand'), level, t
        from cob where event_action is null and message is not null""",
    "gap_meta": f"""select source_system, {_pattern('message')} as raw_pattern, min(parsed_event_time) as first_seen,
        max(parsed_event_time) as last_seen, count(*) as occurrence_count,
        {_last('message', 'parsed_event_time')} as example_message,
        {_last('service_name', 'parsed_event_time')} as service_name, {_last('log_level', 'parsed_event_time')} as log_level
        from gap_src where message <> 'HTTP REQUEST' group by 1, 2""",
    "gap_patterns": f"""select distinct {_pattern('message')} as pattern from api_log
        where event_action is null and message <> 'HTTP REQUEST' and level = 'error'""",
    "gap_state": fx.GAP_STATE.replace("{P}", "gap_patterns").replace("{TS}", _TS),
    "gap": f"""select coalesce(s.raw_pattern, m.raw_pattern) as raw_pattern,
        case when m.raw_pattern is null then s.signature else {_SIGNATURE.replace('raw_pattern', 'm.raw_pattern')} end as signature,
        coalesce(s.source_system, m.source_system) as source_system,
        case when m.raw_pattern is null then s.example_message else m.example_message end as example_message,
        case when m.raw_pattern is null then s.service_name else m.service_name end as service_name,
        least(s.first_seen, m.first_seen) as first_seen,
        case when m.raw_pattern is null then s.last_seen else m.last_seen end as last_seen,
        case when m.raw_pattern is null then s.occurrence_count else m.occurrence_count end as occurrence_count,
        case when m.raw_pattern is null then s.log_level else m.log_level end as log_level,
        case when m.raw_pattern is null then s.classification_status else coalesce(s.classification_status, 'Pending') end as classification_status,
        s.probable_component, s.recommended_event_action, s.notes
        from gap_state s full join gap_meta m on s.raw_pattern = m.raw_pattern and s.source_system = m.source_system""",
    # failures, one shape
    "failures": f"""select 'API' as source, t as event_time, event_action, service_name, user_id, planner_id, request_id, message, error_message
        from api where {_IN} and level = 'error' and coalesce(error_message, message) is not null
        union all select 'Cobrand', t, event_action, source_file, user_id, null, request_id, null, error_message
        from spans where {_IN} and error_message is not null""",
    "dim": """select distinct event_action, 'cobrand' as service_name, null::varchar as method_name, 'render' as layer,
        null::varchar as category, null::varchar as criticality, null::varchar as owner_team, null::varchar as remarks,
        timestamp '2023-12-01 00:00:00' as discovered_at from spans0 where event_action like '%.generate'
        union all select event_action, 'cobrand', min(method_name), null, null, null, null, null, timestamp '2024-02-01 00:00:00'
        from spans0 where event_action not like '%.generate' group by event_action""",
    "recon": """select l.source_file, count(*) as json_rows, count_if(event_id <> 100) as warehouse_rows,
        count(*) + count_if(event_id = 900) as parquet_rows from api_log l group by 1""",
    "man": """select source_file, 'api' as log_type, 'archive/' || source_file as archive_path, json_rows, warehouse_rows, parquet_rows,
        null::timestamp as imported_at, timestamp '2024-02-01 00:00:00' as archived_at, timestamp '2024-02-02 00:00:00' as validated_at,
        case when ok and day <= 5 then timestamp '2024-02-03 00:00:00' end as deleted_at,
        case when not ok then 'FAILED' when day <= 5 then 'DELETED' when day > 25 then 'VALIDATED_KEPT' else 'VALIDATED' end as status,
        case when ok and day <= 5 then sha256(source_file) end as checksum,
        case when ok and day > 25 then 'kept on purpose: validated files are not removed' end as notes
        from (select *, json_rows = warehouse_rows and json_rows = parquet_rows as ok,
              cast(regexp_extract(source_file, '-([0-9]{2})[.]log', 1) as int) as day from recon)""",
}


def _with(body: str) -> str:
    """Put the views a query mentions, and the ones those mention, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in _CTES.items():
            if name not in needed and re.search(rf"\b(from|join)\s+{name}\b", text):
                visit(definition)
                if name not in needed:
                    needed.append(name)

    visit(body)
    views = ",\n".join(f"{name} as ({_CTES[name]})" for name in needed)
    return f"with {views}\n{body}" if needed else body


def _enriched(rows: str, text: str) -> str:
    """Rows of ``rows`` plus their catalog entry."""
    return f"""select r.*, g.signature, g.probable_component, g.recommended_event_action, g.raw_pattern
        from (select *, {text} as match_text from ({rows})) r left join gap g
        on r.event_action is null and g.source_system = upper(r.source) and g.raw_pattern = {_pattern('r.match_text')}"""


def _label(rows: str) -> str:
    return f"""select *, case when event_action is not null then event_action
        when signature is not null and signature is distinct from raw_pattern
          then signature || coalesce(' (' || probable_component || ')', '')
        when message is not null or error_message is not null then 'Uninstrumented Error' else 'Unknown Event' end as label,
        case when error_message is null then '—' else '[ERROR]' end as marker from ({rows})"""


def _ordered(direction: str, columns: str) -> str:
    rest = ", ".join(f"{c.strip()} asc nulls last" for c in columns.split(","))
    return f"event_time {direction} nulls last, {rest}"


_FAILURE_COLUMNS = "source, event_action, service_name, user_id, planner_id, request_id, message, error_message"
_FAILURES_NEWEST = f"select * from failures order by {_ordered('desc', _FAILURE_COLUMNS)} limit 100"

_TIMELINE_COLUMNS = "user_id, source, event_action, level, service_name, request_id, message, error_message"
_TIMELINE = """select user_id, 'API' as source, t as event_time, event_action, level, service_name, request_id, message, error_message
    from api where user_id is not null
    union all select user_id, 'Cobrand', t, event_action, null, source_file, request_id, null, error_message from spans where user_id is not null"""
_TIMELINE_NEWEST = f"""select * exclude (rn) from (select *, row_number() over (partition by user_id
    order by {_ordered('desc', _TIMELINE_COLUMNS)}) as rn from ({_TIMELINE})) where rn <= 200"""

_WORKFLOW = """select request_id, 'API' as source, t as event_time, event_action, method_name, level, null::varchar as result_status, duration_ms,
    message, error_message from api where request_id is not null
    union all select request_id, 'Cobrand', t, event_action, method_name, null, result_status, duration_ms, null, error_message
    from spans where request_id is not null"""
_WORKFLOW_COLUMNS = "request_id, source, event_action, method_name, level, result_status, duration_ms, message, error_message"
_WORKFLOW_OLDEST = f"""select * exclude (rn) from (select *, row_number() over (partition by request_id, source
    order by {_ordered('asc', _WORKFLOW_COLUMNS)}) as rn from ({_WORKFLOW})) where rn <= 5"""
_WORKFLOW_ONE = """select planner_id, 'API' as source, t as event_time, event_action, method_name, level, null::varchar as result_status, duration_ms,
    message, error_message from api where planner_id = 71"""
_EXPLAINED_COLUMNS = _WORKFLOW_COLUMNS + ", match_text, signature, probable_component, recommended_event_action, raw_pattern"


def _top(column: str, count: str, where: str = "true") -> str:
    return f"""select {column}, count(*) as {count} from api where {_IN} and {where} and {column} is not null
        group by 1 order by 2 desc, 1 limit 10"""


def _health(column: str, more: str = "") -> str:
    return f"""select {column}, count(*) as requests, cast(count_if(level = 'error') as integer) as errors,
        round(100.0::double * count_if(level = 'error') / count(*), 2) as error_rate{more}
        from api where {_IN} and {column} is not null group by 1"""


_SPAN_KEY = "source_file, event_time, depth"
# Children are numbered from 0 in order; below them every list has one member.
_PATH = "case depth when 0 then '0' when 1 then '0.' || j when 2 then '0.' || j || '.0' else '0.' || j || '.0.0' end"
_PARENT = "case depth when 0 then null when 1 then '0' when 2 then '0.' || j else '0.' || j || '.0' end"

_GOOD = "event_id % 50 not in (7, 17, 27, 37)"
_BAD = "event_id % 50 in (7, 17, 27, 37)"
_SEARCH = "video_max_fps_too_low"
_FOUND = f"(select raw_pattern from gap where signature ilike '%{_SEARCH}%' or raw_pattern ilike '%{_SEARCH}%')"
_SEARCH_COLUMNS = "source, event_action, level, service_name, user_id, request_id, planner_id, message, error_message, error_stack"


def _hit(columns: str, text: str, search: str = _SEARCH, found: str = _FOUND) -> str:
    literal = " or ".join(f"coalesce({c.strip()} ilike '%{search}%', false)" for c in columns.split(","))
    return f"({literal} or coalesce({_pattern(text)} in {found}, false))"


_SEARCH_API = """select 'API' as source, t as event_time, event_action, level, service_name, user_id, request_id, planner_id, message, error_message,
    error_stack from api"""
_SEARCH_SPANS = """select 'Cobrand' as source, t as event_time, event_action, null::varchar as level, source_file as service_name, user_id, request_id,
    null::bigint as planner_id, null::varchar as message, error_message, error_stack from spans"""
_SEARCH_LOOSE = """select 'Cobrand' as source, t as event_time, event_action, level, source_file as service_name, try_cast(user_id as bigint) as user_id,
    request_id, null::bigint as planner_id, message, error_message, error_stack from cob"""
_API_TEXTS, _SPAN_TEXTS = "message, error_message, error_stack, event_action", "error_message, error_stack, event_action"


def _searched(text: str) -> tuple[str, str]:
    """A search and the patterns that it finds."""
    return text, f"(select raw_pattern from gap where signature ilike '%{text}%' or raw_pattern ilike '%{text}%')"



_DAILY = f"""select cast(t as date) as day, 'API' as source, count(*) as count from api where t is not null and level = 'error' group by 1
    union all select cast(t as date), 'Cobrand', count(*) from spans where t is not null and error_message is not null group by 1"""

_BODIES = {
    # sources
    "ingest_validate": f"""select source_file, 0::bigint as traces, count_if({_GOOD}) as events, count_if({_BAD}) as malformed,
        0::bigint as unreadable_ids from api_log group by 1""",
    "ingest_split": """select source_file, sum(a)::bigint as traces, sum(b)::bigint as events, 0::bigint as malformed,
        sum(c)::bigint as unreadable_ids from (select source_file, 1 as a, 0 as b, 0 as c from spans0 where depth = 0
        union all select source_file, 0, 1, cast(user_id = 'n/a' as int) from cob0) group by 1""",
    "ingest_new_files": """select distinct source_file from api_log where cast(regexp_extract(source_file, '-([0-9]{2})[.]log', 1) as int) > 10""",
    "ledger_pending": """select source_file, rows, cast(case when day % 5 = 0 then 3 else 1 end as bigint) as batch from (
        select source_file, count(*) as rows, cast(regexp_extract(source_file, '-([0-9]{2})[.]log', 1) as int) as day
        from api_log group by 1, 3) where day > 20 or day % 5 = 0 or day % 7 = 0""",
    "ingest_raw_id": """select *, sha256(source_file || chr(10) || line || chr(10) || occurrence) as raw_id from (
        select source_file, line, row_number() over (partition by source_file, line) as occurrence from (
        select 'application-' || strftime(ts, '%Y-%m-%d') || '.log' as source_file,
        '{"event.action":"' || event_type || '","user.id":' || user_id || '}' as line from events))""",
    "rows_per_file": "select source_file, count(*) as rows from api_log group by 1 order by 1",
    # projections
    "flatten_api": f"""select event_time, event_action, message, level, method_name, route_name, request_id, platform_name, planner_id,
        planner_platform_id, user_id, playlist_id, duration_ms, error_message, error_stack, job_name, job_attempt, job_max_attempts,
        http_method, url_path, service_name, t as parsed_event_time, cast(t as date) as event_date, source_file from api where {_GOOD}""",
    "parse_api_time": "select event_id, event_time, t as parsed_event_time from api",
    "parse_cobrand_time": "select conv_id, turn, t as parsed_event_time from cob",
    "event_prefix": f"select event_id, event_action, {_PREFIX} as event_prefix from api_log",
    "first_line": "select doc_id, trim(split_part(text, chr(10), 1), ' ' || chr(13) || chr(10) || chr(9)) as first_line from documents",
    "normalize_message": f"select doc_id, {_normalized('text')} as normalized from documents",
    "noise_filter": "select source_file, count(*) as n from api_log where message <> 'HTTP REQUEST' group by 1",
    "resolve_signature": f"""select raw_pattern, {_SIGNATURE} as signature from (
        select distinct {_pattern('message')} as raw_pattern from api_log where message is not null)""",
    "event_label": "select event_id, label, marker from ("
    + _label(_enriched("select event_id, 'API' as source, event_action, message, error_message from api", "message"))
    + ")",
    # traces
    "trace_flatten": f"""select {_SPAN_KEY}, {_PATH} as path, {_PARENT} as parent_path, source, event_action, method_name, duration_ms,
        result_status, t as parsed_event_time from spans""",
    "trace_fields": f"""select {_SPAN_KEY}, request_id, user_id, user_tracking_id, content_id, user_uuid, content_uuid, content_variation_id,
        content_variation_uuid, content_type, cobrand_job_type, cobrand_status, cobrand_branch, queue_pending_before, queue_pending_after,
        queue_remaining, callback_completed, callback_attempt, callback_max_attempts, generated_file_exists, generated_file_size,
        file_extension from spans""",
    "trace_errors": f"select {_SPAN_KEY}, error_message, error_stack from spans where error_message is not null",
    "span_context": """select source_file, count(*) as spans,
        count_if(depth = 3 or (depth = 1 and (error_message is null or (trace_key + j) % 3 <> 2))) as without_details_all,
        sum(queue_remaining)::bigint as remaining, sum(user_id)::bigint as users from spans0 group by 1""",
    "trace_incremental": """select event_action, depth, count(*) as spans, sum(duration_ms)::decimal(30,2) as duration from spans0
        where trace_key not in (select trace_key from spans0 where result_status = 'done') group by 1, 2""",
    "cobrand_events": """select 'cobrand' as source, event_time, level, event_action, method_name, message, result_status, error_message,
        error_stack, request_id, user_id, user_tracking_id, content_id, t as parsed_event_time, cast(t as date) as event_date, source_file,
        service_name from cob""",
    "dim_span_sync": "select * from dim",
    "dim_span_incremental": "select * from dim",
    "dim_span_backlog": "select event_action from dim where layer is null order by 1",
    # catalogs
    "event_catalog": f"select distinct event_action, {_PREFIX} as event_prefix from api_log where event_action is not null",
    "capability_metadata": "select * from cap_meta",
    "capability_incremental": "select * from cap_meta",
    "capability_sync": "select * from cap",
    "upsert_catalog": """select coalesce(c.c_custkey, o.k) as key, c.c_name as owner,
        case when o.k is null then c.status else coalesce(c.status, 'Pending') end as status,
        least(c.seen, o.first_order) as first_seen, coalesce(o.n, 0) as n
        from (select *, case when c_nationkey % 2 = 0 then 'Reviewed' end as status,
              case when c_nationkey % 3 > 0 then timestamp '1997-01-01 00:00:00' end as seen from customer where c_mktsegment <> 'BUILDING') c
        full join (select o_custkey as k, min(o_orderdate) as first_order, count(*) as n from orders group by 1) o on c.c_custkey = o.k""",
    "capability_backlog": """select event_prefix, event_count, last_seen, sample_event from cap
        where classification_status is null or classification_status = 'Pending'""",
    "coverage_kpis": """select count(*) as total, count_if(classification_status = 'Classified') as classified,
        count_if(coalesce(classification_status, 'Pending') = 'Pending') as pending, count_if(classification_status = 'Deprecated') as deprecated,
        count_if(classification_status = 'Ignored') as ignored,
        count_if(coalesce(classification_status, 'Pending') <> 'Pending')::double / count(*) * 100.0 as coverage_pct from cap""",
    "capability_table": """select event_prefix, capability, subsystem, classification_status, event_count, first_seen, last_seen, sample_event,
        sample_service from cap where coalesce(classification_status, 'Pending') = 'Pending'
        and (event_prefix ilike '%e%' or sample_event ilike '%e%' or capability ilike '%e%')""",
    "recent_discoveries": """select event_prefix, first_seen, event_count, classification_status from cap
        order by first_seen desc nulls last, event_prefix limit 10""",
    "top_event_prefixes": "select event_prefix, event_count from cap where event_count is not null order by 2 desc, 1 limit 10",
    "gap_source": "select * from gap_src",
    "gap_metadata": "select * from gap_meta",
    "gap_incremental": "select * from gap_meta",
    "gap_cobrand": "select * from gap_meta where source_system = 'COBRAND'",
    "gap_sync": "select * from gap",
    "gap_backlog": """select source_system, raw_pattern, signature, occurrence_count, last_seen, example_message from gap
        where coalesce(classification_status, 'Pending') = 'Pending'""",
    "gap_kpis": """select count(*) as total, count_if(coalesce(classification_status, 'Pending') = 'Pending') as pending,
        coalesce(sum(occurrence_count), 0)::bigint as total_occurrences from gap""",
    "gap_table": """select signature, raw_pattern, source_system, occurrence_count, last_seen, classification_status, probable_component,
        recommended_event_action from gap where source_system = 'API' and (raw_pattern ilike '%o%' or signature ilike '%o%')""",
    "enrich_gaps": "select event_id, signature, probable_component, recommended_event_action, raw_pattern from ("
    + _enriched("select event_id, 'API' as source, event_action, message from api", "message")
    + ")",
    "signature_patterns": "select distinct raw_pattern from gap where contains(lower(signature), 'max_fps') or regexp_matches(raw_pattern, 'max.fps', 'i')",
    # metrics
    "date_bounds": "select min(t) as min_date, max(t) as max_date from (select t from api union all select t from spans)",
    "failure_breakdown": f"""select (select count(*) from spans where {_IN} and error_message is not null) as cobrand_failures,
        (select count(*) from api where {_IN} and level = 'error' and event_action like 'posting_job%') as posting_failures""",
    "kpis": f"""select total_events, errors, warnings, unique_users, requests, round(errors::double / total_events * 100, 6) as error_rate,
        round(100.0 - errors::double / total_events * 100, 6) as success_rate, round(avg_duration_ms, 6) as avg_duration_ms from (
        select a.n + s.n as total_events, a.e + s.e as errors, a.w as warnings, a.u as unique_users, a.r as requests, a.d as avg_duration_ms
        from (select count(*) as n, count_if(level = 'error') as e, count_if(level = 'WARN') as w, count(distinct user_id) as u,
              count(distinct request_id) as r, avg(duration_ms) as d from api where {_IN}) a,
             (select count(*) as n, count(error_message) as e from spans where {_IN}) s)""",
    "structured_rate": f"""select count(*) as total, count(event_action) as structured, count(*) - count(event_action) as unstructured,
        round(count(event_action)::double / count(*) * 100, 6) as structured_rate from api where {_IN}""",
    "day_over_day": """with_days select d.day, d.errors, d.warnings, d.cobrand_failures, d.posting_failures,
        nullif(d.errors - coalesce(p.errors, 0), 0) as errors_delta, nullif(d.warnings - coalesce(p.warnings, 0), 0) as warnings_delta,
        nullif(d.cobrand_failures - coalesce(p.cobrand_failures, 0), 0) as cobrand_failures_delta,
        nullif(d.posting_failures - coalesce(p.posting_failures, 0), 0) as posting_failures_delta
        from {DAYS} d left join {DAYS} p on p.day = d.day - interval 1 day""",
    "events_over_time": f"select cast(t as date) as day, count(*) as count from api where {_IN} group by 1 order by 1",
    "errors_over_time": f"select cast(t as date) as day, count(*) as count from api where {_IN} and level = 'error' group by 1 order by 1",
    "failures_over_time": f"{_DAILY} order by 1, 2",
    "failures_by_source": f"select source, sum(count)::bigint as count from ({_DAILY}) group by 1 order by 1",
    "failures_window": _DAILY,
    "top_services": _top("service_name", "count"),
    "top_platforms": _top("platform_name", "count"),
    "top_errors": _top("error_message", "count", "level = 'error'"),
    "top_failed_events": _top("event_action", "count", "level = 'error'"),
    "top_users_errors": _top("user_id", "error_count", "level = 'error'"),
    "top_planners_errors": _top("planner_id", "error_count", "level = 'error'"),
    "service_health": _health("service_name", ", round(avg(duration_ms), 1) as avg_duration_ms"),
    "platform_health": _health("platform_name"),
    "cobrand_health": f"""select count(*) as requests, count(error_message) as errors,
        round(count(error_message)::double / count(*) * 100, 6) as error_rate from spans where {_IN}""",
    # investigation
    "user_summary": """select user_id, sum(a)::bigint as api_events, sum(ae)::bigint as api_errors, sum(c)::bigint as cobrand_events,
        sum(ce)::bigint as cobrand_errors, min(seen) as first_seen, max(seen) as last_seen,
        round((sum(ae) + sum(ce))::double / (sum(a) + sum(c)) * 100, 6) as error_rate from (
        select user_id, 1 as a, cast(level = 'error' as int) as ae, 0 as c, 0 as ce, t as seen from api where user_id is not null
        union all select user_id, 0, 0, 1, cast(error_message is not null as int), null from spans where user_id is not null) group by 1""",
    "user_platforms": "select distinct user_id, platform_name from api_log where user_id is not null and platform_name is not null",
    "user_planners": "select distinct user_id, planner_id from api_log where user_id is not null and planner_id is not null",
    "failure_table": _enriched("select * from failures", "coalesce(message, error_message)"),
    "failures_newest": _enriched(_FAILURES_NEWEST, "coalesce(message, error_message)"),
    "failure_page": f"""select * from ({_enriched(
        "select * from failures where error_message ilike '%upstream%' or message ilike '%upstream%'", "coalesce(message, error_message)")})
        order by {_ordered('desc', _FAILURE_COLUMNS + ', match_text, signature, probable_component, recommended_event_action, raw_pattern')}
        limit 50 offset 100""",
    "user_timeline": _enriched(_TIMELINE, "coalesce(message, error_message)"),
    "user_timeline_newest": _enriched(_TIMELINE_NEWEST, "coalesce(message, error_message)"),
    "user_timeline_one": _enriched(f"select * from ({_TIMELINE}) where user_id = 7", "coalesce(message, error_message)"),
    "workflow_events": _enriched(_WORKFLOW, "coalesce(message, error_message)"),
    "workflow_oldest": _enriched(_WORKFLOW_OLDEST, "coalesce(message, error_message)"),
    "workflow_one": _enriched(_WORKFLOW_ONE, "coalesce(message, error_message)"),
    "workflow_timeline": f"""select request_id, row_number() over (partition by request_id order by {_ordered('asc', _EXPLAINED_COLUMNS)}) ::int as step,
        marker, event_time, source, label from ({_label(_enriched(_WORKFLOW, "coalesce(message, error_message)"))})""",
    "workflow_summary": f"""select request_id, count(*) as events, count(error_message) as failures, min(event_time) as first_event,
        max(event_time) as last_event from ({_WORKFLOW}) group by 1""",
    "raw_log_search": f"""{_SEARCH_API} where {_hit(_API_TEXTS, 'message')}
        union all {_SEARCH_SPANS} where {_hit(_SPAN_TEXTS, 'error_message')}
        union all {_SEARCH_LOOSE} where {_hit(_API_TEXTS, 'message')}""",
    "search_by_ids": f"""select * from ({_SEARCH_API} union all {_SEARCH_SPANS} union all {_SEARCH_LOOSE})
        where user_id = 8 and request_id = 'req-8'""",
    "search_by_planner": f"{_SEARCH_API} where planner_id = 71 and {_hit(_API_TEXTS, 'message', *_searched("upstream"))}",
    "search_cobrand": f"""select * from ({_SEARCH_SPANS} where {_hit(_SPAN_TEXTS, 'error_message', *_searched("not ready"))}
        union all {_SEARCH_LOOSE} where {_hit(_API_TEXTS, 'message', *_searched("not ready"))}) order by {_ordered('desc', _SEARCH_COLUMNS)} limit 300""",
    # audit
    "reconcile_counts": "select *, json_rows = warehouse_rows and json_rows = parquet_rows as passed from recon",
    "reconcile_cobrand": """select source_file, count(*) as json_rows, count(*) as warehouse_rows, count(*) as parquet_rows, true as passed
        from (select source_file from spans0 where depth = 0 union all select source_file from cob0) group by 1""",
    "manifest_status": "select * from man",
    "last_activity": "select max(coalesce(deleted_at, validated_at, archived_at)) as last_activity from man",
    "warehouse_counts": """select 'event_fact_api' as "table", count(*) as rows from api_log
        union all select 'span_fact', count(*) from spans0 union all select 'cobrand_event_fact', count(*) from cob0
        union all select 'event_catalog_api', count(distinct event_action) from api_log
        union all select 'capability_catalog', count(*) from cap union all select 'instrumentation_gap_catalog', count(*) from gap""",
}

_DAYS = """(select day, sum(e)::bigint as errors, sum(w)::bigint as warnings, sum(c)::bigint as cobrand_failures, sum(p)::bigint as posting_failures from (
    select cast(t as date) as day, cast(level = 'error' as int) as e, cast(level = 'WARN' as int) as w, 0 as c,
    cast(level = 'error' and coalesce(event_action, '') like 'posting_job%' as int) as p from api where t is not null
    union all select cast(t as date), cast(error_message is not null as int), 0, cast(error_message is not null as int), 0 from spans where t is not null
    ) group by 1)"""
_BODIES["day_over_day"] = _BODIES["day_over_day"].replace("with_days ", "").replace("{DAYS}", _DAYS)
_BODIES["span_context"] = _BODIES["span_context"].replace("without_details_all", "without_details")

# count_if is a HUGEINT here and a BIGINT in Spark.
ORACLES = {name: re.sub(r"count_if\(", "count(*) filter (", _with(body)) for name, body in _BODIES.items()}

# The same reports between the times of two rows.
_EDGES = f"from api where event_id in {fx.BOUND_EVENTS}"
_RANGE = f"t between (select min(t) {_EDGES}) and (select max(t) {_EDGES})"
ORACLES["kpis_rollup"] = f"select * exclude (requests) from ({ORACLES['kpis']})"
for _name in ("kpis", "events_over_time", "failure_table", "service_health"):
    ORACLES[f"{_name}_range"] = ORACLES[_name].replace(_IN, _RANGE)
