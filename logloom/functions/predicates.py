"""Filters shared by the reports."""

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from logloom.constants import PENDING, POSTING_PATTERN


def within(df: DataFrame, start, end) -> DataFrame:
    """Rows between two times, both included. Rows without a readable time drop out.

    The date filter repeats the bounds on the partition column, so that files of
    other days are never opened.
    """
    start, end = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    if "event_date" in df.columns:
        df = df.where(F.col("event_date").between(start.cast("date"), end.cast("date")))
    return df.where(F.col("parsed_event_time").between(start, end))


def is_api_error() -> Column:
    return F.lower("level") == "error"


def is_api_warning() -> Column:
    return F.lower("level") == "warn"


def is_span_error() -> Column:
    return F.col("error_message").isNotNull()


def is_posting_failure() -> Column:
    return F.col("event_action").like(POSTING_PATTERN) & is_api_error()


def is_unreviewed() -> Column:
    status = F.col("classification_status")
    return status.isNull() | (status == PENDING)


def contains_text(columns: Iterable[str], search: str) -> Column:
    """Case-insensitive substring search over several columns.

    ``%`` and ``_`` typed by the user stay wildcards; a backslash is just a character.
    """
    pattern = "%" + search.replace("\\", "\\\\") + "%"
    return reduce(lambda a, b: a | b, [F.col(c).ilike(pattern) for c in columns])
