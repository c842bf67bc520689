"""Following one failure, user, request or search term through all facts.

Every report with an ``id`` argument also runs without it, for all ids at once, and
gives all rows unless a ``limit`` is asked for. The newest (or oldest) rows per id are
then picked by a ranking that Spark cuts off inside each task before it shuffles, so
an id that owns a third of the rows sends at most ``limit`` rows per task. The cut
needs limits up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (``session.py``);
without a limit nothing is ranked.
"""

from functools import reduce

from pyspark.sql import DataFrame, Row, Window, functions as F

from logloom.constants import API, COBRAND
from logloom.functions import (
    contains_text,
    error_marker,
    event_label,
    is_api_error,
    is_span_error,
    message_pattern,
    whole_number,
    within,
)
from logloom.operators.gaps import enrich, lookup_key, signature_patterns

_TEXT, _LONG = "string", "bigint"


def _missing(name: str, kind: str):
    return F.lit(None).cast(kind).alias(name)


def _as(name: str):
    return F.lit(name).alias("source")


def _order(df: DataFrame, newest: bool) -> list:
    """Total order by time; rows of one time are ordered by their other columns."""
    time = F.desc_nulls_last("event_time") if newest else F.asc_nulls_last("event_time")
    return [time, *[F.asc_nulls_last(c) for c in df.columns if c != "event_time"]]


def _pick(df: DataFrame, limit: int | None, newest: bool = True, per: tuple[str, ...] = ()) -> DataFrame:
    """The first ``limit`` rows in time order, overall or per key; without a limit all rows, unordered."""
    if limit is None:
        return df
    order = _order(df, newest)
    if not per:
        return df.orderBy(*order).limit(limit)
    rank = F.row_number().over(Window.partitionBy(*per).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _explained(rows: DataFrame, catalog: DataFrame) -> DataFrame:
    """Look the row's best text up in the gap catalog."""
    return enrich(rows.withColumn("match_text", F.coalesce("message", "error_message")), catalog, "match_text")


def failure_table(
    events: DataFrame, spans: DataFrame, catalog: DataFrame, start, end, search: str = "", limit: int | None = None
) -> DataFrame:
    """Failures of both facts whose text contains ``search``, explained, newest first.

    With a ``limit`` each branch is cut to it before the union, so the final sort sees
    at most twice that many rows.
    """
    api = (
        within(events, start, end)
        .where(is_api_error() & contains_text(("error_message", "message"), search))
        .select(
            _as(API),
            F.col("parsed_event_time").alias("event_time"),
            "event_action",
            "service_name",
            "user_id",
            "planner_id",
            "request_id",
            "message",
            "error_message",
        )
    )
    cobrand = (
        within(spans, start, end)
        .where(is_span_error() & contains_text(("error_message",), search))
        .select(
            _as(COBRAND),
            F.col("parsed_event_time").alias("event_time"),
            "event_action",
            F.col("source_file").alias("service_name"),
            "user_id",
            _missing("planner_id", _LONG),
            "request_id",
            _missing("message", _TEXT),
            "error_message",
        )
    )
    newest = _pick(_stack([_pick(api, limit), _pick(cobrand, limit)]), limit)
    explained = _explained(newest, catalog)
    return explained.orderBy(*_order(explained, True))


def page(rows: DataFrame, size: int, after: Row | None = None, seen: int = 1) -> DataFrame:
    """``size`` rows of a result in newest-first order, from the newest or from behind the row ``after``.

    Rows are told apart by all of their columns. ``seen`` says how many rows equal to ``after`` earlier pages have
    shown, so that repeated rows are neither lost nor shown twice. Whatever the page, a task keeps ``size`` + ``seen`` rows.
    """
    order = _order(rows, True)
    if after is None:
        return rows.orderBy(*order).limit(size)
    columns = ["event_time", *[c for c in rows.columns if c != "event_time"]]
    types = {f.name: f.dataType for f in rows.schema}
    reached = F.lit(True)
    for name in reversed(columns):
        value, column = F.lit(after[name]).cast(types[name]), F.col(name)
        if after[name] is None:  # nothing stands behind a null
            reached = column.isNull() & reached
        else:
            behind = column < value if name == "event_time" else column > value
            reached = F.coalesce(behind, F.lit(True)) | (column.eqNullSafe(value) & reached)
    return rows.where(reached).orderBy(*order).limit(size + seen).offset(seen)


def last_of(shown: DataFrame, after: Row | None = None, seen: int = 0) -> tuple[Row | None, int]:
    """``after`` and ``seen`` for the page behind one that is ``shown``, given those it was made with."""
    rows = shown.collect()  # one page
    if not rows:
        return after, seen
    same = sum(row == rows[-1] for row in rows)
    return rows[-1], same + (seen if rows[-1] == after else 0)


def labelled(rows: DataFrame) -> DataFrame:
    """Add the header label and the error mark of explained rows."""
    label = event_label(
        *[F.col(c) for c in ("event_action", "signature", "probable_component", "raw_pattern", "message", "error_message")]
    )
    return rows.withColumns({"label": label, "marker": error_marker(F.col("error_message"))})


def user_summary(events: DataFrame, spans: DataFrame, user_id: int | None = None) -> DataFrame:
    """Counts, activity window and error rate per user (or of one user)."""
    events, spans = _of(events, "user_id", user_id), _of(spans, "user_id", user_id)
    t = F.col("parsed_event_time")
    n = F.count(F.lit(1))
    api = events.groupBy("user_id").agg(
        n.alias("api_events"),
        F.count_if(is_api_error()).alias("api_errors"),
        F.min(t).alias("first_seen"),
        F.max(t).alias("last_seen"),
    )
    cobrand = spans.groupBy("user_id").agg(n.alias("cobrand_events"), F.count_if(is_span_error()).alias("cobrand_errors"))
    both = api.unionByName(cobrand, allowMissingColumns=True)
    counts = ("api_events", "api_errors", "cobrand_events", "cobrand_errors")
    total = both.groupBy("user_id").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts],
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    )
    errors, rows = F.col("api_errors") + F.col("cobrand_errors"), F.col("api_events") + F.col("cobrand_events")
    return total.withColumn("error_rate", errors / rows * 100.0)


def user_values(events: DataFrame, column: str, user_id: int | None = None) -> DataFrame:
    """Distinct platforms or planners of each user, one row each (no unbounded lists)."""
    return _of(events, "user_id", user_id).where(F.col(column).isNotNull()).select("user_id", column).distinct()


def _of(df: DataFrame, key: str, value) -> DataFrame:
    """Rows of one id, or the rows that have an id at all."""
    return df.where(F.col(key).isNotNull() if value is None else F.col(key) == F.lit(value))


def user_timeline(
    events: DataFrame, spans: DataFrame, catalog: DataFrame, user_id: int | None = None, limit: int | None = None
) -> DataFrame:
    """The rows of a user over both facts, explained; of every user without ``user_id``. ``limit`` keeps the newest of each."""
    api = _of(events, "user_id", user_id).select(
        "user_id",
        _as(API),
        F.col("parsed_event_time").alias("event_time"),
        "event_action",
        "level",
        "service_name",
        "request_id",
        "message",
        "error_message",
    )
    cobrand = _of(spans, "user_id", user_id).select(
        "user_id",
        _as(COBRAND),
        F.col("parsed_event_time").alias("event_time"),
        "event_action",
        _missing("level", _TEXT),
        F.col("source_file").alias("service_name"),
        "request_id",
        _missing("message", _TEXT),
        "error_message",
    )
    per = ("user_id",) if user_id is None else ()
    return _explained(_pick(_stack([api, cobrand]), limit, per=per), catalog)


ID_COLUMNS = ("request_id", "planner_id", "user_id")


def _workflow_sides(events: DataFrame, spans: DataFrame, id_type: str, id_value) -> list[DataFrame]:
    if id_type not in ID_COLUMNS:
        raise ValueError(f"id_type must be one of {', '.join(ID_COLUMNS)}, not {id_type!r}")
    sides = [
        _of(events, id_type, id_value).select(
            id_type,
            _as(API),
            F.col("parsed_event_time").alias("event_time"),
            "event_action",
            "method_name",
            "level",
            _missing("result_status", _TEXT),
            "duration_ms",
            "message",
            "error_message",
        )
    ]
    if id_type != "planner_id":
        sides.append(
            _of(spans, id_type, id_value).select(
                id_type,
                _as(COBRAND),
                F.col("parsed_event_time").alias("event_time"),
                "event_action",
                "method_name",
                _missing("level", _TEXT),
                "result_status",
                "duration_ms",
                _missing("message", _TEXT),
                "error_message",
            )
        )
    return sides


def workflow_events(
    events: DataFrame, spans: DataFrame, catalog: DataFrame, id_type: str, id_value=None, limit: int | None = None
) -> DataFrame:
    """The rows of a request, planner or user, explained; ``limit`` keeps the oldest of each fact.

    Spans have no planner. Without ``id_value`` every id is reported.
    """
    sides = _workflow_sides(events, spans, id_type, id_value)
    per = (id_type,) if id_value is None else ()
    rows = _stack([_pick(side, limit, newest=False, per=per) for side in sides])
    return _explained(rows, catalog)


def workflow_timeline(explained: DataFrame, id_type: str) -> DataFrame:
    """Number the rows of each id in time order and add label and mark.

    Rows are numbered within their hour and then moved by the rows of the id's earlier hours, so that no task holds an
    id whole: the second window sees one row per id and hour.
    """
    timed = explained.withColumn("_hour", F.date_trunc("hour", F.col("event_time").cast("timestamp")))
    order = [F.asc_nulls_last("event_time"), *[F.asc_nulls_last(c) for c in explained.columns if c != "event_time"]]
    within_hour = F.row_number().over(Window.partitionBy(id_type, "_hour").orderBy(*order))
    hours = timed.groupBy(F.col(id_type).alias("_id"), F.col("_hour").alias("_of")).agg(F.count(F.lit(1)).alias("_rows"))
    running = F.sum("_rows").over(Window.partitionBy("_id").orderBy(F.asc_nulls_last("_of")))
    hours = hours.withColumn("_before", running - F.col("_rows"))
    same = F.col(id_type).eqNullSafe(F.col("_id")) & F.col("_hour").eqNullSafe(F.col("_of"))
    numbered = timed.withColumn("_step", within_hour).join(hours, same)
    step = (F.col("_step") + F.col("_before")).cast("int")
    return labelled(numbered.withColumn("step", step).select(*explained.columns, "step"))


def workflow_steps(events: DataFrame, spans: DataFrame, catalog: DataFrame, id_type: str, id_value=None) -> DataFrame:
    """All rows of a request, planner or user, explained, labelled and numbered in time order."""
    return workflow_timeline(workflow_events(events, spans, catalog, id_type, id_value), id_type)


def labelled_failures(events: DataFrame, spans: DataFrame, catalog: DataFrame, start, end, search: str = "") -> DataFrame:
    """The failure table with header labels; ``page`` shows it page by page."""
    return labelled(failure_table(events, spans, catalog, start, end, search))


def workflow_summary(events: DataFrame, spans: DataFrame, id_type: str, id_value=None) -> DataFrame:
    """Events, failures, first and last time per id, over all of its rows."""
    rows = _stack(_workflow_sides(events, spans, id_type, id_value))
    return rows.groupBy(id_type).agg(
        F.count(F.lit(1)).alias("events"),
        F.count("error_message").alias("failures"),
        F.min("event_time").alias("first_event"),
        F.max("event_time").alias("last_event"),
    )


def search_logs(
    events: DataFrame,
    spans: DataFrame,
    cobrand_events: DataFrame,
    catalog: DataFrame,
    search: str = "",
    user_id: int | None = None,
    request_id: str = "",
    planner_id: int | None = None,
    source: str = "Both",
    limit: int | None = None,
) -> DataFrame:
    """Rows of the three facts that match every given filter; a blank filter is skipped, a ``limit`` keeps the newest.

    A search also finds the lines that normalize to a pattern whose signature or
    text it matches, even if the line itself does not contain it.
    """
    sides = []
    patterns = signature_patterns(catalog, search) if search else None

    def matching(df: DataFrame, columns: tuple[str, ...], text: str) -> DataFrame:
        if not search:
            return df
        literal = F.coalesce(contains_text(columns, search), F.lit(False))
        return _matching_pattern(df, literal, text, patterns)

    if source in ("Both", "API"):
        api = events
        if user_id:
            api = api.where(F.col("user_id") == user_id)
        if request_id:
            api = api.where(F.col("request_id") == request_id)
        if planner_id:
            api = api.where(F.col("planner_id") == planner_id)
        api = matching(api, ("message", "error_message", "error_stack", "event_action"), "message")
        sides.append(
            api.select(
                _as(API),
                F.col("parsed_event_time").alias("event_time"),
                "event_action",
                "level",
                "service_name",
                "user_id",
                "request_id",
                "planner_id",
                "message",
                "error_message",
                "error_stack",
            )
        )
    if source in ("Both", "Cobrand") and not planner_id:
        traced, loose = spans, cobrand_events.withColumn("user_id", whole_number(F.col("user_id")))
        if user_id:
            traced, loose = (df.where(F.col("user_id") == user_id) for df in (traced, loose))
        if request_id:
            traced, loose = (df.where(F.col("request_id") == request_id) for df in (traced, loose))
        traced = matching(traced, ("error_message", "error_stack", "event_action"), "error_message")
        loose = matching(loose, ("message", "error_message", "error_stack", "event_action"), "message")
        for df, level, message in (
            (traced, _missing("level", _TEXT), _missing("message", _TEXT)),
            (loose, F.col("level"), F.col("message")),
        ):
            sides.append(
                df.select(
                    _as(COBRAND),
                    F.col("parsed_event_time").alias("event_time"),
                    "event_action",
                    level,
                    F.col("source_file").alias("service_name"),
                    "user_id",
                    "request_id",
                    _missing("planner_id", _LONG),
                    message,
                    "error_message",
                    "error_stack",
                )
            )
    if not sides:  # spans and standalone lines have no planner
        return search_logs(events.where(F.lit(False)), spans, cobrand_events, catalog, source="API", limit=limit)
    return _pick(_stack([_pick(side, limit) for side in sides]), limit)


def _matching_pattern(df: DataFrame, literal, text: str, patterns: DataFrame) -> DataFrame:
    """Rows that match literally or whose normalized text is one of ``patterns``.

    Rows that already match are not normalized; they and rows without text get
    keys that match nothing, which also spreads them over the tasks.
    """
    flagged = df.withColumn("_literal", literal)
    pattern = F.when(~F.col("_literal"), message_pattern(F.col(text)))
    keyed = flagged.withColumn("_key", lookup_key(pattern, ("parsed_event_time", "request_id", text)))
    known = patterns.select(F.col("raw_pattern").alias("_known"))
    return (
        keyed.join(known, F.col("_key") == F.col("_known"), "left")
        .where(F.col("_literal") | F.col("_known").isNotNull())
        .drop("_literal", "_key", "_known")
    )
