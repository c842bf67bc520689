"""Documents -> event facts."""

from pyspark.sql import DataFrame, functions as F

from logloom.constants import API_FIELDS, COBRAND_EVENT_FIELDS
from logloom.functions import once, parse_api_time, parse_cobrand_time, record


def _with_time(df: DataFrame, parse) -> DataFrame:
    df = once(df, {"parsed_event_time": parse("event_time")})
    return df.withColumn("event_date", F.col("parsed_event_time").cast("date"))


def with_api_time(df: DataFrame) -> DataFrame:
    """Add ``parsed_event_time`` and ``event_date`` to rows with an API time text."""
    return _with_time(df, parse_api_time)


def with_cobrand_time(df: DataFrame) -> DataFrame:
    """Add ``parsed_event_time`` and ``event_date`` to rows with a Cobrand time text."""
    return _with_time(df, parse_cobrand_time)


def flatten_api(docs: DataFrame) -> DataFrame:
    """API documents -> ``event_fact_api``, time parsed once and stored."""
    members = docs.select("source_file", record(F.col("doc"), {key: kind for _, key, kind in API_FIELDS}).alias("m"))
    flat = members.select("source_file", *[F.col(f"m.`{key}`").alias(name) for name, key, _ in API_FIELDS])
    names = [name for name, _, _ in API_FIELDS]
    return with_api_time(flat).select(*names, "parsed_event_time", "event_date", "source_file")


def flatten_standalone(docs: DataFrame) -> DataFrame:
    """Standalone Cobrand documents -> ``cobrand_event_fact``; the whole record is kept."""
    texts = {key: "string" for _, key in COBRAND_EVENT_FIELDS}
    members = docs.select("source_file", "doc", record(F.col("doc"), texts).alias("m"))
    flat = members.select(
        "source_file",
        F.lit("cobrand").alias("source"),
        *[F.col(f"m.`{key}`").alias(name) for name, key in COBRAND_EVENT_FIELDS],
        F.to_json("doc").alias("raw_event"),
    )
    names = [name for name, _ in COBRAND_EVENT_FIELDS]
    return with_cobrand_time(flat).select(
        "source", *names, "raw_event", "parsed_event_time", "event_date", "source_file"
    )
