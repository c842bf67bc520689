"""Log views over the driver's tables.

The tables are not logs, so each view states, in SQL, what a log over the table
would hold. The text is shared by both engines but for the pieces below. The
queries run the library over these views (as facts, or rendered as JSON lines
and read back); the oracles compute the expected result from the same views in
plain SQL and never see anything Spark produced.
"""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logloom.constants import API_FIELDS
from logloom.functions import event_prefix, is_signal, message_pattern, once
from logloom.operators.catalogs import capability_metadata, sync_capabilities
from logloom.operators.flatten import with_api_time, with_cobrand_time
from logloom.operators.gaps import api_gap_source, cobrand_gap_source, gap_metadata, sync_gaps

# Bounds that hold every readable time of the views.
# API lines whose times bound the range reports.
BOUND_EVENTS = (200, 700)

START, END = "1990-01-01 00:00:00", "2035-12-31 23:59:59.999999"

_PIECES = {
    # piece: (Spark, DuckDB)
    "{EVENTS}": ("{events}", "events"),
    "{ORDERS}": ("{orders}", "orders"),
    "{CONVERSATIONS}": ("{conversations}", "conversations"),
    "{DAY}": ("date_format(ts,'yyyy-MM-dd')", "strftime(ts,'%Y-%m-%d')"),
    "{T24}": ("date_format(ts,'EEE, dd MMM yyyy HH:mm:ss a')", "strftime(ts,'%a, %d %b %Y %H:%M:%S %p')"),
    "{T12}": ("date_format(ts,'EEE, dd MMM yyyy hh:mm:ss a')", "strftime(ts,'%a, %d %b %Y %I:%M:%S %p')"),
    "{ISO}": ("date_format(ts,\"yyyy-MM-dd'T'HH:mm:ss'Z'\")", "strftime(ts,'%Y-%m-%dT%H:%M:%SZ')"),
    "{LDAY}": ("date_format(ot,'yyyy-MM-dd')", "strftime(ot,'%Y-%m-%d')"),
    "{LT}": (
        "date_format(ot,'EEE, dd MMM yyyy, hh:mm:ss ') || lower(date_format(ot,'a'))",
        "strftime(ot,'%a, %d %b %Y, %I:%M:%S ') || lower(strftime(ot,'%p'))",
    ),
    "{ORDER_TIME}": (
        "timestampadd(SECOND, cast(o_orderkey * 7 % 86400 as int), o_orderdate)",
        "o_orderdate + to_seconds(o_orderkey * 7 % 86400)",
    ),
    "{TURN_TIME}": (
        "timestampadd(MINUTE, cast(conv_id * 60 + turn as int), timestamp_ntz'2024-01-01 00:00:00')",
        "timestamp '2024-01-01 00:00:00' + to_minutes(conv_id * 60 + turn)",
    ),
    "{CHILDREN}": ("explode(sequence(-1, cast(o_orderkey % 5 as int) - 1))", "unnest(range(-1, o_orderkey % 5))"),
    "{LEVELS}": ("explode(sequence(lowest, deepest))", "unnest(range(lowest, deepest + 1))"),
}

API_LOG = """
with b as (select *, cast(regexp_extract(props, '([0-9]+)', 1) as int) as k from {EVENTS})
select event_id,
 'application-' || {DAY} || '.log' as source_file,
 case when event_id % 3 = 0 then {T24} when event_id % 3 = 1 then {T12} when event_id % 101 = 2 then 'garbage' else {T12} end as event_time,
 case when k % 10 = 0 then null when event_type = 'error' and k % 2 = 1 then 'posting_job.twitter.failed'
      when event_type = 'error' then 'content.cobrand.render' when event_type = 'view' and k % 7 = 0 then 'heartbeat'
      else event_type || '.step' || cast(k % 5 as string) end as event_action,
 case when k = 0 then 'HTTP REQUEST'
      when k = 10 then 'Twitter token refresh failed for user ' || cast(user_id as string)
      when k = 20 then 'ffprobe exited with code 1 at 0x' || lower(hex(event_id)) || chr(13) || chr(10) || 'at line ' || cast(event_id as string)
      when k = 30 then 'The Max FPS found is ' || cast(k as string) || chr(10) || 'stack'
      when k = 40 then 'Planner 00000000-0000-4000-8000-' || lpad(cast(event_id as string), 12, '0') || ' reconciled=' || cast(user_id as string) || ' at ' || {ISO}
      when k = 50 then null
      else 'job ' || cast(event_id as string) || ' done' end as message,
 case when event_type = 'error' then 'error' when event_type = 'signup' then 'WARN' else 'info' end as level,
 case when k % 4 = 3 then null else 'Runner.step' || cast(k % 4 as string) end as method_name,
 case when k % 3 = 0 then '/v1/' || event_type else null end as route_name,
 'req-' || cast(cast(floor(event_id / 4) as bigint) as string) as request_id,
 case when event_type = 'click' then null when user_id % 4 = 0 then 'twitter' when user_id % 4 = 1 then 'linkedin' when user_id % 4 = 2 then 'facebook' else 'whatsapp' end as platform_name,
 case when k % 5 = 0 then null else user_id * 10 + k % 3 end as planner_id,
 case when k % 6 = 0 then user_id * 100 + k else null end as planner_platform_id,
 case when user_id % 29 = 0 then null else user_id end as user_id,
 case when k % 8 = 0 then event_id * 3 else null end as playlist_id,
 value as duration_ms,
 case when event_type = 'error' and k % 4 <> 3 then 'E' || cast(k % 4 as string) || ': upstream failed' else null end as error_message,
 case when event_type = 'error' and k % 8 = 1 then 'Error: boom' || chr(10) || '  at f' || cast(k as string) else null end as error_stack,
 case when k % 9 = 0 then 'job "' || event_type || '"' else null end as job_name,
 case when k % 9 = 0 then k % 5 else null end as job_attempt,
 case when k % 9 = 0 then 5 else null end as job_max_attempts,
 case when k % 2 = 0 then 'GET' else 'POST' end as http_method,
 '/api/' || event_type || '?k=' || cast(k as string) as url_path,
 case when user_id % 17 = 0 then null else 'svc' || cast(user_id % 5 as string) end as service_name
from b
"""

# One trace per order: a root, up to four children, and below a child up to two
# more levels. Rotating error shapes are only visible in the rendered line.
SPANS = """
with o as (select *, {ORDER_TIME} as ot from {ORDERS}),
c as (select *, {CHILDREN} as j from o),
d as (select *, case when j < 0 then 0 else 1 end as lowest,
  case when j < 0 then 0 when (o_custkey + j) % 2 = 1 then 1 when (o_orderkey + j) % 3 = 0 then 3 else 2 end as deepest from c),
n as (select *, {LEVELS} as depth from d)
select o_orderkey as trace_key, j, cast(depth as int) as depth,
 'cobrand-application-' || {LDAY} || '.log' as source_file,
 'cobrand' as source,
 {LT} as event_time,
 case depth when 0 then 'cobrand.job.process' when 1 then
    case j % 3 when 0 then 'cobrand.image.generate' when 1 then 'cobrand.video.generate' else 'cobrand.pdf.generate' end
    when 2 then 'cobrand.s3.upload' else 'cobrand.callback.send' end as event_action,
 case when depth = 0 then 'JobRunner.run' when depth = 1 and o_orderkey % 4 = 0 then null when depth = 1 then 'Generator.make' || cast(o_orderkey % 3 as string)
    when depth = 2 then 'Uploader.put' else 'Callback.send' end as method_name,
 case depth when 0 then o_totalprice when 1 then cast(j * 10 + o_orderkey % 7 as double) + 0.5 when 2 then cast(o_custkey as double) + 0.25 else null end as duration_ms,
 case when depth = 0 then case o_orderstatus when 'F' then 'failed' when 'O' then 'open' else 'done' end when depth = 2 then 'uploaded' else null end as result_status,
 case when depth = 0 and o_orderstatus = 'F' and o_orderkey % 7 = 0 then 'Cobrand is still in progress for job ' || cast(o_orderkey as string)
      when depth = 1 and (o_custkey + 3 * j) % 11 = 0 then 'ffprobe exited with code ' || cast(o_orderkey % 4 as string) || ' at 0x' || lower(hex(o_orderkey)) else null end as error_message,
 case when depth = 1 and (o_custkey + 3 * j) % 11 = 0 then 'Error: boom' || chr(10) || '  at f' || cast(j as string) else null end as error_stack,
 case when depth = 0 then 'req-' || cast(o_orderkey % 2500 as string) else null end as request_id,
 case when depth = 0 then o_custkey else null end as user_id,
 case when depth = 0 and o_orderkey % 3 = 0 then o_orderkey % 100 else null end as user_tracking_id,
 case when depth = 0 then o_orderkey * 2 else null end as content_id,
 case when depth = 2 then '00000000-0000-4000-8000-' || lpad(cast(o_custkey as string), 12, '0') else null end as user_uuid,
 case when depth = 2 then '00000000-0000-4000-9000-' || lpad(cast(o_orderkey as string), 12, '0') else null end as content_uuid,
 case when depth = 2 then o_orderkey * 10 + j else null end as content_variation_id,
 case when depth = 2 and j = 1 then '00000000-0000-4000-a000-' || lpad(cast(o_orderkey as string), 12, '0') else null end as content_variation_uuid,
 case when depth = 2 then o_orderpriority else null end as content_type,
 case when depth = 2 then 'type' || cast(j as string) else null end as cobrand_job_type,
 case when depth = 2 then o_orderstatus else null end as cobrand_status,
 case when depth = 2 then 'branch-' || cast(o_custkey % 9 as string) else null end as cobrand_branch,
 case when depth = 2 then o_custkey + 1 else null end as queue_pending_before,
 case when depth = 2 then o_custkey + 2 else null end as queue_pending_after,
 case when depth = 2 then o_custkey else null end as queue_remaining,
 case when depth = 2 then o_custkey % 3 = 0 else null end as callback_completed,
 case when depth = 2 then cast(o_custkey % 4 as int) else null end as callback_attempt,
 case when depth = 2 then 3 else null end as callback_max_attempts,
 case when depth = 2 then o_orderkey % 2 = 0 else null end as generated_file_exists,
 case when depth = 2 then o_orderkey * 1000 + j else null end as generated_file_size,
 case when depth = 2 then 'pdf' else null end as file_extension
from n
"""

COBRAND_EVENTS = """
with t as (select *, {TURN_TIME} as ot from {CONVERSATIONS})
select conv_id, turn,
 'cobrand-application-2024-01-' || lpad(cast(conv_id % 28 + 1 as string), 2, '0') || '.log' as source_file,
 {LT} as event_time,
 case when turn % 5 = 4 then 'error' else 'info' end as level,
 case when role = 'system' then 'chat.system' else null end as event_action,
 case when turn % 2 = 0 then 'Chat.' || role else null end as method_name,
 text as message,
 case when turn % 3 = 0 then 'sent' else null end as result_status,
 case when turn % 5 = 4 then 'Scheduled post media is not ready yet: ' || cast(conv_id as string) else null end as error_message,
 case when turn % 5 = 4 then 'at turn ' || cast(turn as string) else null end as error_stack,
 'req-' || cast(conv_id as string) as request_id,
 case when conv_id % 7 = 0 then 'n/a' else cast(conv_id % 50 as string) end as user_id,
 cast(conv_id % 11 as string) as user_tracking_id,
 case when turn = 0 then cast(conv_id as string) else null end as content_id,
 case when conv_id % 3 = 0 then 'chat-' || role else null end as service_name
from t
"""


def sql(view: str, engine: str) -> str:
    """The text of a view for ``spark`` or ``duckdb``."""
    for piece, (spark_text, duck_text) in _PIECES.items():
        view = view.replace(piece, spark_text if engine == "spark" else duck_text)
    return view if engine == "spark" else view.replace("as string)", "as varchar)")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    base = re.search(r"\{(EVENTS|ORDERS|CONVERSATIONS)\}", view).group(1).lower()
    return spark.sql(sql(view, "spark"), **{base: table(spark, sf_dir, base)})


def api_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API lines with the time still as text."""
    return _view(spark, sf_dir, API_LOG)


def api_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_fact_api``: times parsed, as the loader stores them."""
    return with_api_time(api_log(spark, sf_dir))


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``span_fact`` as it looks after flattening."""
    return with_cobrand_time(_view(spark, sf_dir, SPANS))


def cobrand_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, COBRAND_EVENTS)


def cobrand_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``cobrand_event_fact``; ``raw_event`` only holds what the reports read from it."""
    service = F.to_json(F.struct(F.col("service_name").alias("service.name")))
    return with_cobrand_time(cobrand_log(spark, sf_dir).withColumn("raw_event", service).drop("service_name"))


def _keyed(df: DataFrame, fields: dict[str, str]) -> Column:
    return F.to_json(F.struct(*[F.col(column).alias(key) for column, key in fields.items()]))


def api_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The API log as text lines, some of them damaged by a fixed rule."""
    keys = {name: key for name, key, _ in API_FIELDS}
    log = api_log(spark, sf_dir)
    rendered = once(log, {"good": _keyed(log, keys)})
    rule, good = F.col("event_id") % 50, F.col("good")
    line = (
        F.when(rule == 7, F.substring(good, F.lit(1), F.length(good) - 1))
        .when(rule == 17, F.concat(good, F.lit(" xyz")))
        .when(rule == 27, F.lit("123"))
        .when(rule == 37, F.concat(good, F.lit("]")))
        .otherwise(good)
    )
    return once(rendered, {"line": line}).select("source_file", "line")


def standalone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standalone Cobrand log as text lines."""
    keys = {
        "event_time": "timestamp",
        "level": "level",
        "event_action": "event.action",
        "method_name": "method.name",
        "message": "message",
        "result_status": "result.status",
        "error_message": "error.message",
        "error_stack": "error.stack",
        "request_id": "request.id",
        "user_id": "user.id",
        "user_tracking_id": "user_tracking.id",
        "content_id": "content.id",
        "service_name": "service.name",
    }
    log = cobrand_log(spark, sf_dir)
    return once(log, {"line": _keyed(log, keys)}).select("source_file", "line")


def trace_lines(spark: SparkSession, sf_dir: str, status: Column | None = None) -> DataFrame:
    """The traces behind ``SPANS`` as nested JSON lines, one per order, or per order of that status.

    Built per row: the child lists are made from the order's own columns. An order of some bytes becomes a line that takes long to
    write and to read, so orders are spread first: a file of many has few splits.
    """
    orders = table(spark, sf_dir, "orders")
    orders = (orders if status is None else orders.where(status)).repartition("o_orderkey")
    timed = orders.withColumn("ot", F.expr(_PIECES["{ORDER_TIME}"][0]))
    o = timed.withColumn("event_time", F.expr(_PIECES["{LT}"][0])).withColumn("day", F.expr(_PIECES["{LDAY}"][0]))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    text = lambda c: c.cast("string")
    uuid = lambda head, c: F.concat(F.lit(f"00000000-0000-4000-{head}-"), F.lpad(text(c), 12, "0"))

    def error_parts(failed, message, stack, shape):
        """(error object, details message, details stack) in one of three shapes."""
        show = lambda n, value: F.when(failed & (shape == n), value)
        error = F.struct(
            show(0, message).alias("message"),
            show(0, stack).alias("stack"),
            show(1, message).alias("error.message"),
            show(1, stack).alias("error.stack"),
        )
        return F.when(failed & (shape < 2), error), show(2, message), show(2, stack)

    def great_grandchild(j):
        return F.struct(F.lit("cobrand.callback.send").alias("event.action"), F.lit("Callback.send").alias("method.name"))

    def grandchild(j):
        details = F.struct(
            uuid("8000", cust).alias("user.uuid"),
            uuid("9000", key).alias("content.uuid"),
            (key * 10 + j).alias("content_variation.id"),
            F.when(j == 1, uuid("a000", key)).alias("content_variation.uuid"),
            F.col("o_orderpriority").alias("content_type.code"),
            F.concat(F.lit("type"), text(j)).alias("cobrand.job.type"),
            F.col("o_orderstatus").alias("cobrand.status"),
            F.concat(F.lit("branch-"), text(cust % 9)).alias("cobrand.branch"),
            (cust + 1).alias("queue.pending_count_before_push"),
            (cust + 2).alias("queue.pending_count_after_push"),
            cust.alias("queue.remaining_count"),
            (cust % 3 == 0).alias("callback.completed"),
            (cust % 4).alias("callback.attempt"),
            F.lit(3).alias("callback.max_attempts"),
            (key % 2 == 0).alias("cobrand.generated_file_exists"),
            (key * 1000 + j).alias("cobrand.generated_file_size_bytes"),
            F.lit("pdf").alias("file.extension"),
        )
        return F.struct(
            F.lit("cobrand.s3.upload").alias("event.action"),
            F.lit("Uploader.put").alias("method.name"),
            (cust.cast("double") + 0.25).alias("event.duration_ms"),
            F.struct(F.lit("uploaded").alias("result.status")).alias("result"),
            details.alias("details"),
            F.when((key + j) % 3 == 0, F.array(great_grandchild(j))).alias("children"),
        )

    def child(j):
        failed = (cust + 3 * j) % 11 == 0
        message = F.concat(F.lit("ffprobe exited with code "), text(key % 4), F.lit(" at 0x"), F.lower(F.hex(key)))
        stack = F.concat(F.lit("Error: boom\n  at f"), text(j))
        error, in_details, stack_in_details = error_parts(failed, message, stack, (key + j) % 3)
        action = (
            F.when(j % 3 == 0, "cobrand.image.generate")
            .when(j % 3 == 1, "cobrand.video.generate")
            .otherwise("cobrand.pdf.generate")
        )
        return F.struct(
            action.alias("event.action"),
            F.when(key % 4 != 0, F.concat(F.lit("Generator.make"), text(key % 3))).alias("method.name"),
            ((j * 10 + key % 7).cast("double") + 0.5).alias("event.duration_ms"),
            error.alias("error"),
            F.struct(in_details.alias("error.message"), stack_in_details.alias("error.stack")).alias("details"),
            F.when((cust + j) % 2 == 0, F.array(grandchild(j))).alias("children"),
        )

    failed = (F.col("o_orderstatus") == "F") & (key % 7 == 0)
    message = F.concat(F.lit("Cobrand is still in progress for job "), text(key))
    error, in_details, _ = error_parts(failed, message, F.lit(None).cast("string"), key % 3)
    size = (key % 5).cast("int")
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "open").otherwise("done")
    root = F.struct(
        F.lit("cobrand.job.process").alias("event.action"),
        F.lit("JobRunner.run").alias("method.name"),
        F.col("o_totalprice").alias("event.duration_ms"),
        F.struct(status.alias("result.status")).alias("result"),
        error.alias("error"),
        F.struct(cust.alias("user.id"), F.lit("req-attribute").alias("request.id")).alias("attributes"),
        F.struct(
            F.concat(F.lit("req-"), text(key % 2500)).alias("request.id"),
            F.when(key % 3 == 0, key % 100).alias("user_tracking.id"),
            (key * 2).alias("content.id"),
            in_details.alias("error.message"),
        ).alias("details"),
        F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1), child)).alias("children"),
    )
    line = F.to_json(F.struct(F.col("event_time").alias("timestamp"), root.alias("trace.method")))
    source_file = F.concat(F.lit("cobrand-application-"), F.col("day"), F.lit(".log"))
    return once(o, {"source_file": source_file, "line": line}).select("source_file", "line")


# A registry as people left it, derived from the prefixes of the log: reviewed or
# not, seen earlier or later than the log says, one stale family.
CAPABILITY_STATE = """
select p.prefix as event_prefix, 'cap_' || p.prefix as capability, 'core' as subsystem, cast(null as string) as description,
 case length(p.prefix) % 4 when 0 then 'Classified' when 1 then 'Deprecated' when 3 then 'Ignored' else null end as classification_status,
 case when length(p.prefix) % 2 = 0 then {TS}'2024-01-15 00:00:00' else {TS}'2023-12-01 00:00:00' end as first_seen,
 {TS}'2024-01-20 00:00:00' as last_seen, cast(1 as bigint) as event_count,
 cast(null as string) as sample_event, cast(null as string) as sample_service
from {P} as p where p.prefix not like 'p%'
union all
select 'legacy.prefix', 'old', 'core', 'kept by hand', 'Pending', cast(null as {TS}), cast(null as {TS}), cast(null as bigint), null, null
"""

# A gap catalog as people left it: it knows the patterns of error lines only.
GAP_STATE = """
select p.pattern as raw_pattern, 'stale label' as signature, 'API' as source_system, cast(null as string) as example_message,
 cast(null as string) as service_name, {TS}'2024-01-15 00:00:00' as first_seen, {TS}'2024-01-16 00:00:00' as last_seen,
 cast(7 as bigint) as occurrence_count, 'info' as log_level,
 case length(p.pattern) % 3 when 0 then 'Classified' when 1 then null else 'Ignored' end as classification_status,
 case when length(p.pattern) % 2 = 0 then 'component ' || cast(length(p.pattern) as string) else null end as probable_component,
 'gap.' || cast(length(p.pattern) as string) as recommended_event_action, 'seen by ops' as notes
from {P} as p
"""


def capability_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = api_log(spark, sf_dir).where(F.col("event_action").isNotNull())
    prefixes = log.select(event_prefix(F.col("event_action")).alias("prefix")).distinct()
    return spark.sql(CAPABILITY_STATE.replace("{TS}", "timestamp_ntz"), P=prefixes)


def gap_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    message = F.col("message")
    log = api_log(spark, sf_dir).where(F.col("event_action").isNull() & is_signal(message) & (F.col("level") == "error"))
    patterns = log.select(message_pattern(message).alias("pattern")).distinct()
    return spark.sql(GAP_STATE.replace("{TS}", "timestamp_ntz"), P=patterns)


def capability_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registry after a sync over that state."""
    return sync_capabilities(capability_state(spark, sf_dir), capability_metadata(api_facts(spark, sf_dir)))


def gap_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return api_gap_source(api_facts(spark, sf_dir)).unionByName(cobrand_gap_source(cobrand_facts(spark, sf_dir)))


def gap_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gap catalog after a sync of both sources over that state."""
    return sync_gaps(gap_state(spark, sf_dir), gap_metadata(gap_source(spark, sf_dir)))
