"""Recurring free-text messages: the instrumentation-gap catalog."""

from pyspark.sql import DataFrame, functions as F

from logloom.constants import DEFAULT_COBRAND_SERVICE, PENDING
from logloom.functions import contains_text, is_signal, is_unreviewed, message_pattern, resolve_signature
from logloom.operators.catalogs import latest
from logloom.operators.upsert import upsert


def api_gap_source(events: DataFrame, *more: str) -> DataFrame:
    """API lines with a message but no event action; ``more`` names columns to keep besides."""
    return _uninstrumented(events).select(
        F.lit("API").alias("source_system"),
        "message",
        "service_name",
        F.col("level").alias("log_level"),
        "parsed_event_time",
        *more,
    )


def cobrand_gap_source(events: DataFrame, *more: str) -> DataFrame:
    """Standalone Cobrand lines with a message but no event action; ``more`` as above."""
    service = F.get_json_object("raw_event", "$['service.name']")
    return _uninstrumented(events).select(
        F.lit("COBRAND").alias("source_system"),
        "message",
        F.coalesce(service, F.lit(DEFAULT_COBRAND_SERVICE)).alias("service_name"),
        F.col("level").alias("log_level"),
        "parsed_event_time",
        *more,
    )


def _uninstrumented(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_action").isNull() & F.col("message").isNotNull())


def _patterns(source: DataFrame) -> DataFrame:
    """Noise (nearly all of a typical log) is dropped before anything is normalized."""
    return source.where(is_signal(F.col("message"))).withColumn("raw_pattern", message_pattern(F.col("message")))


def gap_metadata(source: DataFrame) -> DataFrame:
    """Per source and pattern: first and last time, count, latest message, service and level."""
    t = F.col("parsed_event_time")
    return _patterns(source).groupBy("source_system", "raw_pattern").agg(
        F.min(t).alias("first_seen"),
        F.max(t).alias("last_seen"),
        F.count("*").alias("occurrence_count"),
        latest("message", "parsed_event_time").alias("example_message"),
        latest("service_name", "parsed_event_time"),
        latest("log_level", "parsed_event_time"),
    )


def fold_gaps(source: DataFrame) -> DataFrame:
    """The same per source file, in a form that can be merged; ``source`` keeps ``source_file``.

    A latest value travels with its own time, as the row that carries the latest
    service need not be the row that carries the latest message. Stored per file,
    so that a refresh normalizes the messages of new files only.
    """
    t = F.col("parsed_event_time")
    seen = {c: F.max(F.when(F.col(c).isNotNull(), t)) for c in ("service_name", "log_level")}
    return _patterns(source).groupBy("source_file", "source_system", "raw_pattern").agg(
        F.min(t).alias("first_seen"),
        F.max(t).alias("last_seen"),
        F.count("*").alias("occurrence_count"),
        latest("message", "parsed_event_time").alias("example_message"),
        latest("service_name", "parsed_event_time"),
        latest("log_level", "parsed_event_time"),
        seen["service_name"].alias("service_seen"),
        seen["log_level"].alias("level_seen"),
    )


def no_gaps(events: DataFrame, source_system: str) -> DataFrame:
    """Per source file, how many rows ``fold_gaps`` leaves out (structured, silent or noise)."""
    message = F.col("message")
    gap = F.col("event_action").isNull() & message.isNotNull() & is_signal(message)
    return events.groupBy("source_file").agg(F.count_if(~gap).alias("occurrence_count")).withColumn(
        "source_system", F.lit(source_system)
    )


def gap_totals(folded: DataFrame) -> DataFrame:
    """Merge the files' shares into what ``gap_metadata`` gives for all of them."""
    return (
        folded.where(F.col("raw_pattern").isNotNull())
        .groupBy("source_system", "raw_pattern")
        .agg(
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
            F.sum("occurrence_count").alias("occurrence_count"),
            latest("example_message", "last_seen"),
            latest("service_name", "service_seen"),
            latest("log_level", "level_seen"),
        )
    )


def with_signature(metadata: DataFrame) -> DataFrame:
    """Label the patterns. After the aggregate: once per pattern, not once per line."""
    return metadata.withColumn("signature", resolve_signature(F.col("raw_pattern")))


def sync_gaps(catalog: DataFrame, metadata: DataFrame) -> DataFrame:
    """Bring the catalog up to date; signatures follow the current rules, human columns stay."""
    return upsert(
        catalog,
        with_signature(metadata),
        keys=("source_system", "raw_pattern"),
        overwrite=("signature", "last_seen", "occurrence_count", "example_message", "service_name", "log_level"),
        earliest=("first_seen",),
        defaults={"classification_status": PENDING},
    )


def gap_backlog(catalog: DataFrame, source_system: str | None = None) -> DataFrame:
    """Unreviewed patterns, most frequent first, of one source or of all."""
    if source_system:
        catalog = catalog.where(F.col("source_system") == source_system)
    return (
        catalog.where(is_unreviewed())
        .select("source_system", "raw_pattern", "signature", "occurrence_count", "last_seen", "example_message")
        .orderBy("source_system", F.desc_nulls_last("occurrence_count"), "raw_pattern")
    )


def gap_kpis(catalog: DataFrame) -> DataFrame:
    return catalog.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(is_unreviewed()).alias("pending"),
        F.coalesce(F.sum("occurrence_count"), F.lit(0)).alias("total_occurrences"),
    )


def gap_table(catalog: DataFrame, source_system: str = "All", search: str = "") -> DataFrame:
    if source_system != "All":
        catalog = catalog.where(F.col("source_system") == source_system)
    if search:
        catalog = catalog.where(contains_text(("raw_pattern", "signature"), search))
    return catalog.select(
        "signature",
        "raw_pattern",
        "source_system",
        "occurrence_count",
        "last_seen",
        "classification_status",
        "probable_component",
        "recommended_event_action",
    ).orderBy(F.desc_nulls_last("occurrence_count"), "source_system", "raw_pattern")


def signature_patterns(catalog: DataFrame, search: str) -> DataFrame:
    """Distinct patterns whose signature or text matches a search."""
    return (
        catalog.where(contains_text(("signature", "raw_pattern"), search) & F.col("raw_pattern").isNotNull())
        .select("raw_pattern")
        .distinct()
    )


def lookup_key(pattern, spread_over):
    """Join key of a row: its pattern, or, without one, a key that matches nothing.

    A NULL key would send all such rows to one task. Patterns never contain a
    digit (digit runs became ``{n}``), so numbers are free to spread them.
    """
    return F.coalesce(pattern, F.xxhash64(*spread_over).cast("string"))


def enrich(rows: DataFrame, catalog: DataFrame, text: str, source: str = "source") -> DataFrame:
    """Add what the catalog knows about rows without an event action.

    Adds ``signature``, ``probable_component``, ``recommended_event_action`` and
    ``raw_pattern``; all NULL for rows with an action or without an entry. The
    join side and strategy are left to the optimizer: the catalog is broadcast
    while its measured size allows it, and shuffled beyond.
    """
    # Noise is never in the catalog, so it is not looked up; else nearly all rows would share one key.
    asks = F.col("event_action").isNull() & is_signal(F.col(text))
    pattern = F.when(asks, message_pattern(F.col(text)))
    keyed = rows.withColumns(
        {"_system": F.upper(source), "_key": lookup_key(pattern, ("event_time", text, source))}
    ).alias("r")
    known = catalog.select(
        F.col("source_system").alias("_g_system"),
        F.col("raw_pattern").alias("_g_pattern"),
        "signature",
        "probable_component",
        "recommended_event_action",
        "raw_pattern",
    ).alias("g")
    on = (F.col("r._system") == F.col("g._g_system")) & (F.col("r._key") == F.col("g._g_pattern"))
    return keyed.join(known, on, "left").select(
        *[F.col(f"r.{c}") for c in rows.columns],
        "g.signature",
        "g.probable_component",
        "g.recommended_event_action",
        "g.raw_pattern",
    )
