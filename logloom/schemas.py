"""Table schemas. Nothing is ever inferred from the log text."""

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from logloom.constants import API_FIELDS, COBRAND_EVENT_FIELDS


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "variant": T.VariantType(),
}


def _schema(columns: str) -> T.StructType:
    """``"name type, ..."`` as a schema (Spark's own DDL parser needs a running session)."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = _schema("raw_id string, doc variant, line string, kind string, source_file string")

EVENT_FACT_API = _schema(
    ", ".join(f"{name} {kind}" for name, _, kind in API_FIELDS)
    + ", parsed_event_time timestamp_ntz, event_date date, source_file string"
)

SPAN_FACT = _schema(
    """trace_id string, span_id string, parent_id string, depth int, source string,
    event_time string, request_id string, event_action string, method_name string, duration_ms double,
    result_status string, error_message string, error_stack string, user_id bigint, user_uuid string,
    user_tracking_id bigint, content_id bigint, content_uuid string, content_variation_id bigint,
    content_variation_uuid string, content_type string, cobrand_job_type string, cobrand_status string,
    cobrand_branch string, queue_pending_before bigint, queue_pending_after bigint, queue_remaining bigint,
    callback_completed boolean, callback_attempt int, callback_max_attempts int, generated_file_exists boolean,
    generated_file_size bigint, file_extension string, raw_id string, parsed_event_time timestamp_ntz,
    event_date date, source_file string"""
)

SPAN_CONTEXT = _schema("span_id string, attributes string, details string, source_file string")

COBRAND_EVENT_FACT = _schema(
    "source string, "
    + ", ".join(f"{name} string" for name, _ in COBRAND_EVENT_FIELDS)
    + ", raw_event string, parsed_event_time timestamp_ntz, event_date date, source_file string"
)

# What each source file contributes to the catalogs. The counts of a file add up
# to its rows in the fact; gap rows without a pattern stand for lines that are no gap.
EVENT_SHARES = _schema(
    """event_action string, service_name string, first_seen timestamp_ntz, last_seen timestamp_ntz,
    event_count bigint, source_file string"""
)

GAP_SHARES = _schema(
    """raw_pattern string, first_seen timestamp_ntz, last_seen timestamp_ntz, occurrence_count bigint,
    example_message string, service_name string, service_seen timestamp_ntz, log_level string,
    level_seen timestamp_ntz, source_system string, source_file string"""
)

SPAN_SHARES = _schema("event_action string, method_name string, source string, span_count bigint, source_file string")

EVENT_CATALOG_API = _schema("event_action string, event_prefix string")

CAPABILITY_CATALOG = _schema(
    """event_prefix string, capability string, subsystem string, description string,
    classification_status string, first_seen timestamp_ntz, last_seen timestamp_ntz, event_count bigint,
    sample_event string, sample_service string"""
)

INSTRUMENTATION_GAP_CATALOG = _schema(
    """raw_pattern string, signature string, source_system string, example_message string, service_name string,
    first_seen timestamp_ntz, last_seen timestamp_ntz, occurrence_count bigint, log_level string,
    classification_status string, probable_component string, recommended_event_action string, notes string"""
)

DIM_SPAN = _schema(
    """event_action string, service_name string, method_name string, layer string, category string,
    criticality string, owner_team string, remarks string, discovered_at timestamp_ntz"""
)

ARCHIVE = _schema("raw_json string, log_type string, year string, month string, source_file string")

ARCHIVE_MANIFEST = _schema(
    """source_file string, log_type string, archive_path string, json_rows bigint, warehouse_rows bigint,
    parquet_rows bigint, imported_at timestamp_ntz, archived_at timestamp_ntz, validated_at timestamp_ntz,
    deleted_at timestamp_ntz, status string, checksum string, notes string"""
)

FILE_LEDGER = _schema(
    """step string, source_file string, rows bigint, length bigint, modified_at timestamp, batch bigint,
    recorded_at timestamp_ntz"""
)

LOAD_FAILURES = _schema("log_type string, source_file string, reason string, failed_at timestamp_ntz")

# table -> (schema, partition columns). Tables without partition columns are small
# registries that are rewritten as a new version; the others grow by partition.
TABLES = {
    "raw_api": (RAW, ("kind", "source_file")),
    "raw_cobrand": (RAW, ("kind", "source_file")),
    "event_fact_api": (EVENT_FACT_API, ("event_date", "source_file")),
    "span_fact": (SPAN_FACT, ("event_date", "source_file")),
    "span_context": (SPAN_CONTEXT, ("source_file",)),
    "cobrand_event_fact": (COBRAND_EVENT_FACT, ("event_date", "source_file")),
    "event_shares": (EVENT_SHARES, ("source_file",)),
    "gap_shares": (GAP_SHARES, ("source_system", "source_file")),
    "span_shares": (SPAN_SHARES, ("source_file",)),
    "file_ledger": (FILE_LEDGER, ("step",)),
    "event_catalog_api": (EVENT_CATALOG_API, ()),
    "capability_catalog": (CAPABILITY_CATALOG, ()),
    "instrumentation_gap_catalog": (INSTRUMENTATION_GAP_CATALOG, ()),
    "dim_span": (DIM_SPAN, ()),
    "archive_manifest": (ARCHIVE_MANIFEST, ()),
    "load_failures": (LOAD_FAILURES, ()),
}


def conform(df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Bring an older table to ``schema``: rename, add missing columns as NULL, cast.

    A rename only applies while the new name is absent. Columns outside the
    schema are kept behind it, so nothing a person entered is lost.
    """
    for old, new in (renames or {}).items():
        if old in df.columns and new not in df.columns:
            df = df.withColumnRenamed(old, new)
    known = [
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ]
    extra = [F.col(f"`{c}`") for c in df.columns if c not in schema.names]
    return df.select(*known, *extra)
