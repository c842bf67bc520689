"""Failures per day, on a stream or on a table."""

from pyspark.sql import DataFrame, functions as F

from logloom.constants import API, COBRAND
from logloom.functions import is_api_error, is_span_error


def daily_failures(events: DataFrame, spans: DataFrame, late: str | None = None) -> DataFrame:
    """Failures per day and source over tumbling one-day windows.

    On streams pass ``late``: rows later than that behind the newest time seen
    are dropped, and finished days are emitted once. A back-fill beyond it is
    only exact in a batch.
    """
    sides = [
        df.where(failed).select("parsed_event_time", F.lit(name).alias("source"))
        for df, failed, name in ((events, is_api_error(), API), (spans, is_span_error(), COBRAND))
    ]
    # Windows and watermarks need an instant; the session zone is UTC, as are the logs.
    failures = sides[0].unionByName(sides[1]).where(F.col("parsed_event_time").isNotNull())
    failures = failures.withColumn("at", F.col("parsed_event_time").cast("timestamp"))
    if late:
        failures = failures.withWatermark("at", late)
    return (
        failures.groupBy(F.window("at", "1 day"), "source")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(F.col("window.start").cast("date").alias("day"), "source", "count")
    )
