"""Registries of event families and of span actions."""

from pyspark.sql import DataFrame, functions as F

from logloom.constants import PENDING
from logloom.functions import contains_text, event_prefix, is_unreviewed
from logloom.operators.upsert import upsert


def event_catalog(events: DataFrame) -> DataFrame:
    """Distinct event actions with their prefix."""
    action = F.col("event_action")
    return events.where(action.isNotNull()).select("event_action").distinct().withColumn("event_prefix", event_prefix(action))


def latest(value: str, time: str):
    """Value of the latest row that has both; among equal times the greatest value."""
    usable = F.col(value).isNotNull() & F.col(time).isNotNull()
    return F.max_by(F.col(value), F.when(usable, F.struct(F.col(time), F.col(value)))).alias(value)


def fold_events(events: DataFrame, *by: str) -> DataFrame:
    """First and last time and count per (action, service), and per ``by``.

    All states are fixed-width, so this hashes and folds the facts map-side. Folded
    per source file the result is stored, and a refresh folds new files only.
    """
    t = F.col("parsed_event_time")
    return events.groupBy(*by, "event_action", "service_name").agg(
        F.min(t).alias("first_seen"), F.max(t).alias("last_seen"), F.count("*").alias("event_count")
    )


def capability_totals(folded: DataFrame) -> DataFrame:
    """Per event prefix: first and last time, count, latest action and service.

    Picking the latest texts needs a sort, but only of the folded rows.
    """
    known = folded.where(F.col("event_action").isNotNull())
    return (
        known.groupBy(event_prefix(F.col("event_action")).alias("event_prefix"))
        .agg(
            latest("event_action", "last_seen"),
            latest("service_name", "last_seen"),
            F.min("first_seen").alias("first_seen"),
            F.sum("event_count").alias("event_count"),
            F.max("last_seen").alias("last_seen"),
        )
        .select(
            "event_prefix",
            "first_seen",
            "last_seen",
            "event_count",
            F.col("event_action").alias("sample_event"),
            F.col("service_name").alias("sample_service"),
        )
    )


def capability_metadata(events: DataFrame) -> DataFrame:
    return capability_totals(fold_events(events.where(F.col("event_action").isNotNull())))


def sync_capabilities(catalog: DataFrame, metadata: DataFrame) -> DataFrame:
    """Bring the registry up to date; what people entered stays."""
    return upsert(
        catalog,
        metadata,
        keys=("event_prefix",),
        overwrite=("last_seen", "event_count", "sample_event", "sample_service"),
        earliest=("first_seen",),
        defaults={"classification_status": PENDING},
    )


def capability_backlog(catalog: DataFrame) -> DataFrame:
    """Prefixes nobody has reviewed, most frequent first."""
    return (
        catalog.where(is_unreviewed())
        .select("event_prefix", "event_count", "last_seen", "sample_event")
        .orderBy(F.desc_nulls_last("event_count"), "event_prefix")
    )


def coverage_kpis(catalog: DataFrame) -> DataFrame:
    """How much of the registry has been reviewed; one row."""
    status = F.col("classification_status")
    counts = catalog.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(status == "Classified").alias("classified"),
        F.count_if(is_unreviewed()).alias("pending"),
        F.count_if(status == "Deprecated").alias("deprecated"),
        F.count_if(status == "Ignored").alias("ignored"),
    )
    reviewed = F.col("total") - F.col("pending")
    return counts.withColumn(
        "coverage_pct", F.when(F.col("total") > 0, reviewed / F.col("total") * 100.0).otherwise(F.lit(0.0))
    )


def capability_table(catalog: DataFrame, status: str = "All", search: str = "") -> DataFrame:
    """The registry, filtered by status (``All``, ``Pending`` or an exact one) and text."""
    if status == PENDING:
        catalog = catalog.where(is_unreviewed())
    elif status != "All":
        catalog = catalog.where(F.col("classification_status") == status)
    if search:
        catalog = catalog.where(contains_text(("event_prefix", "sample_event", "capability"), search))
    return catalog.select(
        "event_prefix",
        "capability",
        "subsystem",
        "classification_status",
        "event_count",
        "first_seen",
        "last_seen",
        "sample_event",
        "sample_service",
    ).orderBy(F.desc_nulls_last("event_count"), "event_prefix")


def recent_discoveries(catalog: DataFrame, limit: int = 10) -> DataFrame:
    return (
        catalog.select("event_prefix", "first_seen", "event_count", "classification_status")
        .orderBy(F.desc_nulls_last("first_seen"), "event_prefix")
        .limit(limit)
    )


def top_event_prefixes(catalog: DataFrame, limit: int = 10) -> DataFrame:
    """All-time totals straight from the registry."""
    return (
        catalog.where(F.col("event_count").isNotNull())
        .select("event_prefix", "event_count")
        .orderBy(F.desc("event_count"), "event_prefix")
        .limit(limit)
    )


def _first_span():
    """Of several spans the one with the smallest method name (none comes last), then source."""
    return F.min(F.struct(F.col("method_name").isNull().alias("unnamed"), "method_name", "source")).alias("first")


def fold_spans(spans: DataFrame, *by: str) -> DataFrame:
    """First method name and source and number of spans per action, and per ``by``.

    The state is one row of fixed columns, so it folds map-side and merges by the same minimum: stored per source file,
    a refresh folds new files only. Spans without an action are counted as well, so that a file's share accounts for all its rows.
    """
    folded = spans.groupBy(*by, "event_action").agg(_first_span(), F.count("*").alias("span_count"))
    return folded.select("event_action", "first.method_name", "first.source", "span_count", *by)


def new_span_actions(folded: DataFrame, dimension: DataFrame, now=None) -> DataFrame:
    """Rows to append to ``dim_span``: one per unseen action, with its first method name; from folded spans or shares."""
    known = dimension.select("event_action")
    merged = folded.where(F.col("event_action").isNotNull()).groupBy("event_action").agg(_first_span())
    fresh = merged.join(known, "event_action", "left_anti")
    discovered = F.lit(now).cast("timestamp_ntz") if now is not None else F.localtimestamp()
    return fresh.select(
        "event_action",
        F.col("first.source").alias("service_name"),
        "first.method_name",
        *[F.lit(None).cast("string").alias(c) for c in ("layer", "category", "criticality", "owner_team", "remarks")],
        discovered.alias("discovered_at"),
    )


def merge_dimension(shares: DataFrame, dimension: DataFrame, now=None) -> DataFrame:
    """The dimension brought up to date from stored shares; no span is read."""
    return dimension.unionByName(new_span_actions(shares, dimension, now))


def sync_dimension(spans: DataFrame, dimension: DataFrame, now=None) -> DataFrame:
    return merge_dimension(fold_spans(spans), dimension, now)


def dimension_backlog(dimension: DataFrame) -> DataFrame:
    return dimension.where(F.col("layer").isNull()).select("event_action").orderBy("event_action")
