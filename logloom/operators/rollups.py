"""Daily rollups whose rows merge: headline figures of any range of whole days without reading a fact.

``figures`` has a row per (day, source): sums, and a sketch of the request ids. ``users`` has a row per (day, block of
32,768 user ids): a bitmap of the ids that were seen, so distinct users are exact and a row has 4 KB at most. Both grow with days
and users, not with events. Rollups of separate loads of a day are stacked and merged; rows without a readable time
belong to no day and are left out.
"""

from pyspark.sql import DataFrame, functions as F

from logloom.constants import API, COBRAND
from logloom.functions import is_api_error, is_api_warning, is_posting_failure, is_span_error

#: log2 of the sketch's cells: its standard error is about 1.04 / sqrt(2 ** 12), 1.6 percent.
SKETCH = 12
_SUMS = ("total_events", "errors", "warnings", "posting_failures", "duration_sum", "durations")


def daily_figures(events: DataFrame, spans: DataFrame) -> DataFrame:
    """``(day, source, sums, requests)`` of both facts; the sketch and what spans have no column for are null for spans."""
    day = F.col("parsed_event_time").cast("date").alias("day")
    total = F.count("*").alias("total_events")
    api = events.where("parsed_event_time is not null").groupBy(day, F.lit(API).alias("source")).agg(
        total,
        F.count_if(is_api_error()).alias("errors"),
        F.count_if(is_api_warning()).alias("warnings"),
        F.count_if(is_posting_failure()).alias("posting_failures"),
        F.sum("duration_ms").alias("duration_sum"),
        F.count("duration_ms").alias("durations"),
        F.hll_sketch_agg("request_id", F.lit(SKETCH)).alias("requests"),
    )
    cobrand = spans.where("parsed_event_time is not null").groupBy(day, F.lit(COBRAND).alias("source")).agg(
        total, F.count_if(is_span_error()).alias("errors")
    )
    return api.unionByName(cobrand, allowMissingColumns=True)


def daily_users(events: DataFrame) -> DataFrame:
    """``(day, block, users)`` of API events: bitmaps of the users seen, without those that have no id."""
    seen = events.where("parsed_event_time is not null and user_id is not null")
    return seen.groupBy(
        F.col("parsed_event_time").cast("date").alias("day"), F.bitmap_bucket_number("user_id").alias("block")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("users"))


def merge_figures(figures: DataFrame) -> DataFrame:
    """One row per (day, source) again, after rollups of several loads were stacked."""
    return figures.groupBy("day", "source").agg(
        *[F.sum(name).alias(name) for name in _SUMS], F.hll_union_agg("requests").alias("requests")
    )


def merge_users(users: DataFrame) -> DataFrame:
    """One row per (day, block) again."""
    return users.groupBy("day", "block").agg(F.bitmap_or_agg("users").alias("users"))


def kpis(figures: DataFrame, users: DataFrame, first, last) -> DataFrame:
    """The headline figures of whole days, both included; one row, with the columns of ``metrics.kpis``.

    ``unique_users`` is exact, ``requests`` an estimate of the distinct request ids (see ``SKETCH``). Rollups that
    were stacked and not merged give the same figures, but for that estimate, which may differ within its error.
    """
    days = F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    sums = figures.where(days).agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("total_events", "errors", "warnings", "durations")],
        F.sum("duration_sum").alias("duration_sum"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("requests")), F.lit(0)).cast("long").alias("requests"),
    )
    # A user seen on many days is one bit of one block.
    blocks = users.where(days).groupBy("block").agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
    counted = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unique_users"))
    names = ("total_events", "errors", "warnings", "durations", "duration_sum", "requests", "unique_users")
    one = sums.unionByName(counted, allowMissingColumns=True).agg(*[F.max(name).alias(name) for name in names])
    rate = F.when(F.col("total_events") > 0, F.col("errors") / F.col("total_events") * 100.0).otherwise(F.lit(0.0))
    return one.select(
        "total_events",
        "errors",
        "warnings",
        "unique_users",
        "requests",
        rate.alias("error_rate"),
        (100.0 - rate).alias("success_rate"),
        F.when(F.col("durations") > 0, F.col("duration_sum") / F.col("durations")).alias("avg_duration_ms"),
    )
