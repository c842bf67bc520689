"""The registered queries: each runs library operators over whole tables."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from checks.fixtures import END, START
from logloom import functions as fn
from logloom.operators import archive, catalogs, flatten, gaps, investigate, manifest, metrics, rollups, traces
from logloom.operators.upsert import upsert
from logloom.sources import ledger, logs

QUERIES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


# --- sources ------------------------------------------------------------------------------------


@query
def ingest_validate(spark: SparkSession, d: str) -> DataFrame:
    """Good and malformed lines per API file."""
    return logs.quality_report(logs.parse_lines(fx.api_lines(spark, d)))


@query
def ingest_split(spark, d):
    """Trace and standalone lines per Cobrand file."""
    lines = fx.trace_lines(spark, d).unionByName(fx.standalone_lines(spark, d))
    return logs.quality_report(logs.parse_lines(lines))


@query
def ingest_new_files(spark, d):
    """Files not in the ledger, which knows the first ten days of each month."""
    rows = fx.api_log(spark, d)
    known = rows.where(F.regexp_extract("source_file", r"-(\d\d)[.]log", 1).cast("int") <= 10)
    return logs.new_files(rows.select("source_file").distinct(), known)


@query
def ledger_pending(spark, d):
    """Files whose facts are behind their lines: never built, taken back, or older than lines that were loaded again."""
    files = fx.api_log(spark, d).groupBy("source_file").agg(F.count(F.lit(1)).alias("rows"))
    day = F.regexp_extract("source_file", r"-(\d\d)[.]log", 1).cast("int")

    def entries(step, batch, chosen, rows="rows"):
        return files.where(chosen).select(
            F.lit(step).alias("step"), "source_file", F.expr(rows).cast("bigint").alias("rows"), F.lit(batch).cast("bigint").alias("batch")
        )

    book = entries("raw_api", 1, F.lit(True)).unionByName(entries("event_fact_api", 2, day <= 20))
    book = book.unionByName(entries("raw_api", 3, day % 5 == 0)).unionByName(entries("event_fact_api", 4, day % 7 == 0, "null"))
    return ledger.pending(book, "raw_api", "event_fact_api")


@query
def ingest_raw_id(spark, d):
    """Row ids of lines that repeat within their file."""
    line = F.concat(F.lit('{"event.action":"'), "event_type", F.lit('","user.id":'), F.col("user_id").cast("string"), F.lit("}"))
    lines = fx.table(spark, d, "events").select(
        F.concat(F.lit("application-"), F.date_format("ts", "yyyy-MM-dd"), F.lit(".log")).alias("source_file"), line.alias("line")
    )
    return logs.with_raw_id(logs.number_copies(lines))


@query
def rows_per_file(spark, d):
    return logs.rows_per_file(logs.parse_lines(fx.api_lines(spark, d)))


# --- projections ----------------------------------------------------------------------------------


@query
def flatten_api(spark, d):
    """Text lines -> documents -> the API fact."""
    good = logs.documents(logs.parse_lines(fx.api_lines(spark, d)))
    return flatten.flatten_api(good)


@query
def parse_api_time(spark, d):
    log = fx.api_log(spark, d)
    return log.select("event_id", "event_time", fn.parse_api_time("event_time").alias("parsed_event_time"))


@query
def parse_cobrand_time(spark, d):
    log = fx.cobrand_log(spark, d)
    return log.select("conv_id", "turn", fn.parse_cobrand_time("event_time").alias("parsed_event_time"))


@query
def event_prefix(spark, d):
    log = fx.api_log(spark, d)
    return log.select("event_id", "event_action", fn.event_prefix(F.col("event_action")).alias("event_prefix"))


@query
def first_line(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", fn.first_line(F.col("text")).alias("first_line"))


@query
def normalize_message(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", fn.normalize_message(F.col("text")).alias("normalized"))


@query
def noise_filter(spark, d):
    log = fx.api_log(spark, d)
    return log.where(fn.is_signal(F.col("message"))).groupBy("source_file").agg(F.count(F.lit(1)).alias("n"))


@query
def resolve_signature(spark, d):
    log = fx.api_log(spark, d).where(F.col("message").isNotNull())
    patterns = log.select(fn.message_pattern(F.col("message")).alias("raw_pattern")).distinct()
    return patterns.withColumn("signature", fn.resolve_signature(F.col("raw_pattern")))


@query
def event_label(spark, d):
    """Labels of all API lines after the catalog lookup."""
    rows = fx.api_facts(spark, d).select(
        "event_id",
        F.lit("API").alias("source"),
        F.col("parsed_event_time").alias("event_time"),
        "event_action",
        "message",
        "error_message",
    )
    explained = gaps.enrich(rows, fx.gap_catalog(spark, d), "message")
    return investigate.labelled(explained).select("event_id", "label", "marker")


# --- traces -----------------------------------------------------------------------------------------


def _identified(lines):
    """The id is the digest of the first copy of the line."""
    return logs.with_raw_id(lines.withColumn("occurrence", F.lit(1)))


def _traces(spark, d):
    """Rendered trace lines, read back."""
    return logs.traces(logs.parse_lines(_identified(fx.trace_lines(spark, d))))


def _nodes(spark, d):
    return traces.span_nodes(_traces(spark, d))


_SPAN_KEYS = ("source_file", "event_time", "depth")


@query
def trace_flatten(spark, d):
    """Every span of every trace, with its place in the tree."""
    spans = traces.span_facts(_nodes(spark, d))
    path = F.split_part("span_id", F.lit("/"), F.lit(2))
    parent = F.split_part("parent_id", F.lit("/"), F.lit(2))
    return spans.select(
        *_SPAN_KEYS,
        path.alias("path"),
        parent.alias("parent_path"),
        "source",
        "event_action",
        "method_name",
        "duration_ms",
        "result_status",
        "parsed_event_time",
    )


@query
def trace_fields(spark, d):
    """Values lifted out of details and attributes."""
    spans = traces.span_facts(_nodes(spark, d))
    lifted = ("request_id", "user_id", "user_tracking_id", "content_id", "user_uuid", "content_uuid", "content_variation_id",
              "content_variation_uuid", "content_type", "cobrand_job_type", "cobrand_status", "cobrand_branch",
              "queue_pending_before", "queue_pending_after", "queue_remaining", "callback_completed", "callback_attempt",
              "callback_max_attempts", "generated_file_exists", "generated_file_size", "file_extension")
    return spans.select(*_SPAN_KEYS, *lifted)


@query
def trace_errors(spark, d):
    """Error texts in all three shapes."""
    spans = traces.span_facts(_nodes(spark, d)).where(F.col("error_message").isNotNull())
    return spans.select(*_SPAN_KEYS, "error_message", "error_stack")


@query
def span_context(spark, d):
    """The complete details of upload spans, read back from the stored JSON."""
    context = traces.span_context(_nodes(spark, d))
    detail = lambda key: F.get_json_object("details", f"$['{key}']")
    return context.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("spans"),
        F.count_if(F.col("details") == "{}").alias("without_details"),
        F.sum(detail("queue.remaining_count").cast("bigint")).alias("remaining"),
        F.sum(F.get_json_object("attributes", "$['user.id']").cast("bigint")).alias("users"),
    )


@query
def trace_incremental(spark, d):
    """Spans of the traces that are not parsed yet; the traces of finished orders are."""
    # What is stored of the finished ones is known by the ids of their lines; nothing is read back for it.
    finished = ~F.coalesce(F.col("o_orderstatus").isin("F", "O"), F.lit(False))
    done = _identified(fx.trace_lines(spark, d, finished)).select("raw_id", F.lit(0).alias("depth"))
    spans = traces.span_facts(traces.span_nodes(traces.unparsed(_traces(spark, d), done)))
    return spans.groupBy("event_action", "depth").agg(F.count(F.lit(1)).alias("spans"), F.sum("duration_ms").cast("decimal(30,2)").alias("duration"))


@query
def cobrand_events(spark, d):
    """Standalone lines -> documents -> the Cobrand event fact."""
    docs = logs.standalone(logs.parse_lines(fx.standalone_lines(spark, d)))
    service = F.get_json_object("raw_event", "$['service.name']")
    return flatten.flatten_standalone(docs).withColumn("service_name", service).drop("raw_event")


@query
def dim_span_sync(spark, d):
    spans = fx.spans(spark, d)
    return catalogs.sync_dimension(spans, _known_actions(spans), now="2024-02-01 00:00:00")


@query
def dim_span_incremental(spark, d):
    """The same from the shares of the single files."""
    spans = fx.spans(spark, d)
    shares = catalogs.fold_spans(spans, "source_file")
    return catalogs.merge_dimension(shares, _known_actions(spans), now="2024-02-01 00:00:00")


def _known_actions(spans):
    """A dimension that knows the generators already."""
    known = spans.where(F.col("event_action").like("%.generate")).select("event_action").distinct()
    empty = F.lit(None).cast("string")
    return known.select(
        "event_action",
        F.lit("cobrand").alias("service_name"),
        empty.alias("method_name"),
        F.lit("render").alias("layer"),
        *[empty.alias(c) for c in ("category", "criticality", "owner_team", "remarks")],
        F.lit("2023-12-01 00:00:00").cast("timestamp_ntz").alias("discovered_at"),
    )


@query
def dim_span_backlog(spark, d):
    spans = fx.spans(spark, d)
    return catalogs.dimension_backlog(catalogs.sync_dimension(spans, _known_actions(spans)))


# --- catalogs ----------------------------------------------------------------------------------------


@query
def event_catalog(spark, d):
    return catalogs.event_catalog(fx.api_log(spark, d))


@query
def capability_metadata(spark, d):
    return catalogs.capability_metadata(fx.api_facts(spark, d))


@query
def capability_incremental(spark, d):
    """The same from the shares of the single files."""
    return catalogs.capability_totals(catalogs.fold_events(fx.api_facts(spark, d), "source_file"))


@query
def capability_sync(spark, d):
    return fx.capability_catalog(spark, d)


@query
def upsert_catalog(spark, d):
    """The bare upsert: customers' registry, refreshed from their orders."""
    customers = fx.table(spark, d, "customer")
    current = customers.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_custkey").alias("key"),
        F.col("c_name").alias("owner"),
        F.when(F.col("c_nationkey") % 2 == 0, "Reviewed").alias("status"),
        F.when(F.col("c_nationkey") % 3 > 0, F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")).alias("first_seen"),
        F.lit(0).cast("bigint").alias("n"),
    )
    incoming = fx.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("key")).agg(
        F.min("o_orderdate").alias("first_seen"), F.count(F.lit(1)).alias("n")
    )
    return upsert(current, incoming, ("key",), ("n",), ("first_seen",), {"status": "Pending"})


@query
def capability_backlog(spark, d):
    return catalogs.capability_backlog(fx.capability_catalog(spark, d))


@query
def coverage_kpis(spark, d):
    return catalogs.coverage_kpis(fx.capability_catalog(spark, d))


@query
def capability_table(spark, d):
    return catalogs.capability_table(fx.capability_catalog(spark, d), "Pending", "e")


@query
def recent_discoveries(spark, d):
    return catalogs.recent_discoveries(fx.capability_catalog(spark, d))


@query
def top_event_prefixes(spark, d):
    return catalogs.top_event_prefixes(fx.capability_catalog(spark, d))


@query
def gap_source(spark, d):
    return fx.gap_source(spark, d)


@query
def gap_metadata(spark, d):
    return gaps.gap_metadata(fx.gap_source(spark, d))


@query
def gap_incremental(spark, d):
    """The same from the shares of the single files."""
    source = gaps.api_gap_source(fx.api_facts(spark, d), "source_file").unionByName(
        gaps.cobrand_gap_source(fx.cobrand_facts(spark, d), "source_file")
    )
    return gaps.gap_totals(gaps.fold_gaps(source))


@query
def gap_cobrand(spark, d):
    return gaps.gap_metadata(gaps.cobrand_gap_source(fx.cobrand_facts(spark, d)))


@query
def gap_sync(spark, d):
    return fx.gap_catalog(spark, d)


@query
def gap_backlog(spark, d):
    return gaps.gap_backlog(fx.gap_catalog(spark, d))


@query
def gap_kpis(spark, d):
    return gaps.gap_kpis(fx.gap_catalog(spark, d))


@query
def gap_table(spark, d):
    return gaps.gap_table(fx.gap_catalog(spark, d), "API", "o")


@query
def enrich_gaps(spark, d):
    """All API lines with what the catalog knows about them."""
    rows = fx.api_facts(spark, d).select(
        "event_id", F.lit("API").alias("source"), F.col("parsed_event_time").alias("event_time"), "event_action", "message"
    )
    explained = gaps.enrich(rows, fx.gap_catalog(spark, d), "message")
    return explained.select("event_id", "signature", "probable_component", "recommended_event_action", "raw_pattern")


@query
def signature_patterns(spark, d):
    return gaps.signature_patterns(fx.gap_catalog(spark, d), "max_fps")


# --- metrics -------------------------------------------------------------------------------------------


def _both(spark, d):
    return fx.api_facts(spark, d), fx.spans(spark, d)


@query
def date_bounds(spark, d):
    return metrics.date_bounds(*_both(spark, d))


@query
def failure_breakdown(spark, d):
    return metrics.failure_breakdown(*_both(spark, d), START, END)


@query
def kpis(spark, d):
    return _rounded(metrics.kpis(*_both(spark, d), START, END), "avg_duration_ms", "error_rate", "success_rate")


def _rounded(df, *columns):
    """Cut the noise of floating-point summation order before results are compared."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query
def kpis_rollup(spark, d):
    """The same figures from daily rollups of two separate loads, without the estimated one."""
    events, spans = _both(spark, d)
    halves = [(events.where(part), spans.where(part)) for part in ("hour(parsed_event_time) < 12", "hour(parsed_event_time) >= 12")]
    figures = rollups.merge_figures(reduce(DataFrame.unionByName, [rollups.daily_figures(*half) for half in halves]))
    users = rollups.merge_users(reduce(DataFrame.unionByName, [rollups.daily_users(half[0]) for half in halves]))
    found = rollups.kpis(figures, users, START[:10], END[:10]).drop("requests")
    return _rounded(found, "avg_duration_ms", "error_rate", "success_rate")


@query
def structured_rate(spark, d):
    return _rounded(metrics.structured_rate(fx.api_facts(spark, d), START, END), "structured_rate")


@query
def day_over_day(spark, d):
    return metrics.day_over_day(*_both(spark, d))


@query
def events_over_time(spark, d):
    return metrics.events_over_time(fx.api_facts(spark, d), START, END)


@query
def errors_over_time(spark, d):
    return metrics.errors_over_time(fx.api_facts(spark, d), START, END)


@query
def failures_over_time(spark, d):
    return metrics.failures_over_time(*_both(spark, d), START, END)


@query
def failures_by_source(spark, d):
    return metrics.failures_by_source(*_both(spark, d), START, END)


@query
def failures_window(spark, d):
    """The windowed aggregate the stream runs, over the same rows in a batch."""
    from logloom.streaming.windows import daily_failures

    events, spans = _both(spark, d)
    counts = daily_failures(events, spans)
    return counts.select(F.col("day"), "source", "count")


def _top(name, report):
    def run(spark, d):
        return report(fx.api_facts(spark, d), START, END)

    run.__name__ = name
    query(run)


_top("top_services", metrics.top_services)
_top("top_platforms", metrics.top_platforms)
_top("top_errors", metrics.top_errors)
_top("top_failed_events", metrics.top_failed_events)
_top("top_users_errors", metrics.top_users_with_errors)
_top("top_planners_errors", metrics.top_planners_with_errors)


@query
def service_health(spark, d):
    return metrics.service_health(fx.api_facts(spark, d), START, END)


@query
def platform_health(spark, d):
    return metrics.platform_health(fx.api_facts(spark, d), START, END)


@query
def cobrand_health(spark, d):
    return _rounded(metrics.cobrand_health(fx.spans(spark, d), START, END), "error_rate")


def _bounds(spark, d):
    """Two times that are rows' own, with other rows before, between and behind them."""
    log = fx.api_log(spark, d).where(F.col("event_id").isin(*fx.BOUND_EVENTS))
    t = fn.parse_api_time("event_time")
    return log.agg(F.min(t), F.max(t)).first()


@query
def kpis_range(spark, d):
    return _rounded(metrics.kpis(*_both(spark, d), *_bounds(spark, d)), "error_rate", "success_rate", "avg_duration_ms")


@query
def events_over_time_range(spark, d):
    return metrics.events_over_time(fx.api_facts(spark, d), *_bounds(spark, d))


@query
def failure_table_range(spark, d):
    return investigate.failure_table(*_both(spark, d), fx.gap_catalog(spark, d), *_bounds(spark, d))


@query
def service_health_range(spark, d):
    return metrics.service_health(fx.api_facts(spark, d), *_bounds(spark, d))


# --- investigation ----------------------------------------------------------------------------------------


@query
def user_summary(spark, d):
    return _rounded(investigate.user_summary(*_both(spark, d)), "error_rate")


@query
def user_platforms(spark, d):
    return investigate.user_values(fx.api_facts(spark, d), "platform_name")


@query
def user_planners(spark, d):
    return investigate.user_values(fx.api_facts(spark, d), "planner_id")


@query
def failure_table(spark, d):
    return investigate.failure_table(*_both(spark, d), fx.gap_catalog(spark, d), START, END)


@query
def failure_page(spark, d):
    """The third page, reached over the last rows of the first two."""
    rows = investigate.failure_table(*_both(spark, d), fx.gap_catalog(spark, d), START, END, search="upstream")
    after, seen = None, 0
    for _ in range(2):
        after, seen = investigate.last_of(investigate.page(rows, 50, after, seen), after, seen)
    return investigate.page(rows, 50, after, seen)


@query
def failures_newest(spark, d):
    return investigate.failure_table(*_both(spark, d), fx.gap_catalog(spark, d), START, END, limit=100)


@query
def user_timeline(spark, d):
    return investigate.user_timeline(*_both(spark, d), fx.gap_catalog(spark, d))


@query
def user_timeline_newest(spark, d):
    return investigate.user_timeline(*_both(spark, d), fx.gap_catalog(spark, d), limit=200)


@query
def user_timeline_one(spark, d):
    return investigate.user_timeline(*_both(spark, d), fx.gap_catalog(spark, d), user_id=7)


@query
def workflow_events(spark, d):
    return investigate.workflow_events(*_both(spark, d), fx.gap_catalog(spark, d), "request_id")


@query
def workflow_oldest(spark, d):
    return investigate.workflow_events(*_both(spark, d), fx.gap_catalog(spark, d), "request_id", limit=5)


@query
def workflow_one(spark, d):
    return investigate.workflow_events(*_both(spark, d), fx.gap_catalog(spark, d), "planner_id", 71)


@query
def workflow_timeline(spark, d):
    rows = investigate.workflow_events(*_both(spark, d), fx.gap_catalog(spark, d), "request_id")
    return investigate.workflow_timeline(rows, "request_id").select(
        "request_id", "step", "marker", "event_time", "source", "label"
    )


@query
def workflow_summary(spark, d):
    return investigate.workflow_summary(*_both(spark, d), "request_id")


@query
def raw_log_search(spark, d):
    """A signature that no line contains literally."""
    return investigate.search_logs(
        *_both(spark, d), fx.cobrand_facts(spark, d), fx.gap_catalog(spark, d), search="VIDEO_MAX_FPS_TOO_LOW"
    )


@query
def search_by_ids(spark, d):
    """Both sources by user and request; every filter must hold."""
    facts = (*_both(spark, d), fx.cobrand_facts(spark, d), fx.gap_catalog(spark, d))
    return investigate.search_logs(*facts, user_id=8, request_id="req-8")


@query
def search_by_planner(spark, d):
    """Only API rows have a planner."""
    facts = (*_both(spark, d), fx.cobrand_facts(spark, d), fx.gap_catalog(spark, d))
    return investigate.search_logs(*facts, search="upstream", planner_id=71)


@query
def search_cobrand(spark, d):
    facts = (*_both(spark, d), fx.cobrand_facts(spark, d), fx.gap_catalog(spark, d))
    return investigate.search_logs(*facts, search="not ready", source="Cobrand", limit=300)


# --- audit ---------------------------------------------------------------------------------------------------


def _reconciled(spark, d):
    """Counts per file: the log, what was loaded, what was archived.

    One load lost a line (the last event of the log), one archive holds a line twice.
    """
    log = fx.api_log(spark, d).select("event_id", "source_file")
    loaded = log.where(F.col("event_id") != 100)
    archived = log.unionByName(log.where(F.col("event_id") == 900))
    return archive.reconcile(*[archive.count_per_file(df) for df in (log, loaded, archived)])


@query
def reconcile_counts(spark, d):
    return _reconciled(spark, d)


@query
def reconcile_cobrand(spark, d):
    """A Cobrand line is loaded as a trace or as a standalone event."""
    lines = fx.trace_lines(spark, d).unionByName(fx.standalone_lines(spark, d))
    checked = logs.parse_lines(lines)
    loaded = archive.count_per_file(checked.where(F.col("kind").isin("trace", "event")))
    read = archive.count_per_file(lines)
    return archive.reconcile(read, loaded, read)


def _manifest(spark, d):
    """Archive all files, validate them, and keep or delete the sources by day."""
    at = lambda text: F.lit(text).cast("timestamp_ntz")
    counts = _reconciled(spark, d).withColumn("log_type", F.lit("api"))
    archived = counts.select(
        "source_file", "log_type", F.concat(F.lit("archive/"), "source_file").alias("archive_path")
    )
    empty = archived.where(F.lit(False))
    state = manifest.record_archived(manifest.empty_like(empty), archived, at("2024-02-01 00:00:00"))
    state = manifest.record_validation(state, counts, at("2024-02-02 00:00:00"))
    day = F.regexp_extract("source_file", r"-(\d\d)[.]log", 1).cast("int")
    valid = state.where(F.col("status") == "VALIDATED").withColumn("day", day)
    gone = valid.where(F.col("day") <= 5).select("log_type", "source_file", F.sha2("source_file", 256).alias("checksum"))
    state = manifest.record_deleted(state, gone, at("2024-02-03 00:00:00"))
    return manifest.record_kept(state, valid.where(F.col("day") > 25).select("log_type", "source_file"))


@query
def manifest_status(spark, d):
    return _manifest(spark, d)


@query
def last_activity(spark, d):
    return manifest.last_activity(_manifest(spark, d))


@query
def warehouse_counts(spark, d):
    """Rows of every table derived from the given ones."""
    from logloom.sources.tables import inventory

    events, spans = _both(spark, d)
    return inventory(
        {
            "event_fact_api": events,
            "span_fact": spans,
            "cobrand_event_fact": fx.cobrand_facts(spark, d),
            "event_catalog_api": catalogs.event_catalog(events),
            "capability_catalog": fx.capability_catalog(spark, d),
            "instrumentation_gap_catalog": fx.gap_catalog(spark, d),
        }
    )
