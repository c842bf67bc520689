"""Operational metrics over the two facts.

``events`` is ``event_fact_api`` and ``spans`` is ``span_fact``; both carry
``parsed_event_time``. Every aggregate folds map-side, so a hot key costs one
row per task in the shuffle.
"""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logloom.constants import API, COBRAND
from logloom.functions import is_api_error, is_api_warning, is_posting_failure, is_span_error, within


def _percent(part: Column, whole: Column) -> Column:
    """Share in percent; 0 when there is nothing to share."""
    return F.when(whole > 0, part / whole * 100.0).otherwise(F.lit(0.0))


def _day() -> Column:
    return F.col("parsed_event_time").cast("date").alias("day")


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def date_bounds(events: DataFrame, spans: DataFrame) -> DataFrame:
    """Earliest and latest readable time of both facts; one row."""
    t = F.col("parsed_event_time")
    each = [df.agg(F.min(t).alias("min_date"), F.max(t).alias("max_date")) for df in (events, spans)]
    return _stack(each).agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def failure_breakdown(events: DataFrame, spans: DataFrame, start, end) -> DataFrame:
    """Cobrand failures and posting failures; one row."""
    posting = within(events, start, end).agg(F.count_if(is_posting_failure()).alias("posting_failures"))
    cobrand = within(spans, start, end).agg(F.count_if(is_span_error()).alias("cobrand_failures"))
    return _stack([cobrand, posting]).agg(
        F.max("cobrand_failures").alias("cobrand_failures"), F.max("posting_failures").alias("posting_failures")
    )


def kpis(events: DataFrame, spans: DataFrame, start, end, exact: bool = True) -> DataFrame:
    """Headline figures of both facts; one row. Durations are those of API events only.

    ``exact=False`` estimates the two distinct counts with fixed-size sketches,
    which spares the shuffle of every distinct request id.
    """
    api = within(events, start, end)
    distinct = F.count_distinct if exact else F.approx_count_distinct
    counted = {"unique_users": distinct("user_id"), "requests": distinct("request_id")}
    figures = {
        "total_events": F.count("*"),
        "errors": F.count_if(is_api_error()),
        "warnings": F.count_if(is_api_warning()),
        "avg_duration_ms": F.avg("duration_ms"),
    }
    # Several exact distinct counts in one aggregate would write every row out once for each of them.
    each = [figures, *({name: count} for name, count in counted.items())] if exact else [figures | counted]
    sides = [api.agg(*[column.alias(name) for name, column in part.items()]) for part in each]
    cobrand = within(spans, start, end).agg(
        F.count("*").alias("total_events"), F.count_if(is_span_error()).alias("errors")
    )
    rate = _percent(F.col("errors"), F.col("total_events"))
    return (
        _stack([*sides, cobrand])
        .agg(
            F.sum("total_events").alias("total_events"),
            F.sum("errors").alias("errors"),
            F.max("warnings").alias("warnings"),
            F.max("unique_users").alias("unique_users"),
            F.max("requests").alias("requests"),
            F.max("avg_duration_ms").alias("avg_duration_ms"),
        )
        .withColumn("error_rate", rate)
        .withColumn("success_rate", 100.0 - F.col("error_rate"))
        .select(
            "total_events",
            "errors",
            "warnings",
            "unique_users",
            "requests",
            "error_rate",
            "success_rate",
            "avg_duration_ms",
        )
    )


def structured_rate(events: DataFrame, start, end) -> DataFrame:
    """Share of API events that carry an event action; one row."""
    counts = within(events, start, end).agg(F.count("*").alias("total"), F.count("event_action").alias("structured"))
    return counts.select(
        "total",
        "structured",
        (F.col("total") - F.col("structured")).alias("unstructured"),
        _percent(F.col("structured"), F.col("total")).alias("structured_rate"),
    )


def events_over_time(events: DataFrame, start, end) -> DataFrame:
    return within(events, start, end).groupBy(_day()).agg(F.count("*").alias("count")).orderBy("day")


def errors_over_time(events: DataFrame, start, end) -> DataFrame:
    return events_over_time(events.where(is_api_error()), start, end)


def _failures_per_day(events: DataFrame, spans: DataFrame, start, end) -> DataFrame:
    sides = ((events, is_api_error(), API), (spans, is_span_error(), COBRAND))
    return _stack(
        [
            within(df, start, end).where(failed).groupBy(_day(), F.lit(name).alias("source")).agg(F.count("*").alias("count"))
            for df, failed, name in sides
        ]
    )


def failures_over_time(events: DataFrame, spans: DataFrame, start, end) -> DataFrame:
    """Failures per day and source."""
    return _failures_per_day(events, spans, start, end).orderBy("day", "source")


def failures_by_source(events: DataFrame, spans: DataFrame, start, end) -> DataFrame:
    daily = _failures_per_day(events, spans, start, end)
    return daily.groupBy("source").agg(F.sum("count").alias("count")).orderBy("source")


def day_over_day(events: DataFrame, spans: DataFrame, day=None) -> DataFrame:
    """Four daily failure figures and their change against the calendar day before.

    Without ``day`` every day with data is reported. A missing day counts as 0 and
    "no change" is NULL. Each daily row is used for its own day and, negated, for
    the next one, so the facts are aggregated once and nothing is self-joined.
    """
    names = ("errors", "warnings", "cobrand_failures", "posting_failures")
    failed = F.count_if(is_span_error())
    if day is not None:
        last = F.lit(day).cast("date")
        bounds = (F.date_sub(last, 1), F.date_add(last, 1) - F.expr("interval 1 microsecond"))
        events, spans = within(events, *bounds), within(spans, *bounds)
    timed = F.col("parsed_event_time").isNotNull()
    daily = _stack(
        [
            events.where(timed)
            .groupBy(_day())
            .agg(
                F.count_if(is_api_error()).alias("errors"),
                F.count_if(is_api_warning()).alias("warnings"),
                F.count_if(is_posting_failure()).alias("posting_failures"),
            ),
            spans.where(timed).groupBy(_day()).agg(failed.alias("errors"), failed.alias("cobrand_failures")),
        ]
    )
    total = daily.groupBy("day").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    both = total.select(
        F.explode(
            F.array(
                F.struct(F.col("day"), F.lit(1).alias("here"), *[F.col(n) for n in names]),
                F.struct(F.date_add("day", 1).alias("day"), F.lit(0).alias("here"), *[(-F.col(n)).alias(n) for n in names]),
            )
        ).alias("d")
    ).select("d.*")
    compared = (
        both.groupBy("day")
        .agg(
            F.max("here").alias("here"),
            *[F.sum(F.when(F.col("here") == 1, F.col(n)).otherwise(0)).alias(n) for n in names],
            *[F.nullif(F.sum(n), F.lit(0)).alias(f"{n}_delta") for n in names],
        )
        .where((F.col("here") == 1) if day is None else (F.col("day") == last))
    )
    return compared.drop("here").orderBy("day")


def _top(df: DataFrame, key: str, count: str, limit: int) -> DataFrame:
    """Most frequent values of a column; equal counts are ordered by value."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias(count))
        .orderBy(F.desc(count), key)
        .limit(limit)
    )


def top_services(events: DataFrame, start, end, limit: int = 10) -> DataFrame:
    return _top(within(events, start, end), "service_name", "count", limit)


def top_platforms(events: DataFrame, start, end, limit: int = 10) -> DataFrame:
    return _top(within(events, start, end), "platform_name", "count", limit)


def top_errors(events: DataFrame, start, end, limit: int = 10) -> DataFrame:
    return _top(within(events, start, end).where(is_api_error()), "error_message", "count", limit)


def top_failed_events(events: DataFrame, start, end, limit: int = 10) -> DataFrame:
    return _top(within(events, start, end).where(is_api_error()), "event_action", "count", limit)


def top_users_with_errors(events: DataFrame, start, end, limit: int = 10) -> DataFrame:
    return _top(within(events, start, end).where(is_api_error()), "user_id", "error_count", limit)


def top_planners_with_errors(events: DataFrame, start, end, limit: int = 10) -> DataFrame:
    return _top(within(events, start, end).where(is_api_error()), "planner_id", "error_count", limit)


def _health(events: DataFrame, key: str, start, end, *more: Column) -> DataFrame:
    errors = F.count_if(is_api_error())
    return (
        within(events, start, end)
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("*").alias("requests"),
            errors.cast("int").alias("errors"),
            F.round(F.lit(100.0) * errors / F.count("*"), 2).alias("error_rate"),
            *more,
        )
        .orderBy(F.desc("requests"), key)
    )


def service_health(events: DataFrame, start, end) -> DataFrame:
    """Requests, errors, error rate and mean duration per service."""
    return _health(events, "service_name", start, end, F.round(F.avg("duration_ms"), 1).alias("avg_duration_ms"))


def platform_health(events: DataFrame, start, end) -> DataFrame:
    return _health(events, "platform_name", start, end)


def cobrand_health(spans: DataFrame, start, end) -> DataFrame:
    """Requests, errors and error rate over all spans; one row."""
    counts = within(spans, start, end).agg(F.count("*").alias("requests"), F.count_if(is_span_error()).alias("errors"))
    return counts.withColumn("error_rate", _percent(F.col("errors"), F.col("requests")))
