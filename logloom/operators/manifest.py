"""The audit trail: one row per source file, moving through its life."""

from pyspark.sql import Column, DataFrame, functions as F

from logloom import schemas
from logloom.constants import ARCHIVED, DELETED, FAILED, KEPT_NOTE, VALIDATED, VALIDATED_KEPT
from logloom.operators.upsert import update, upsert


def empty_like(df: DataFrame) -> DataFrame:
    """An empty manifest in the session (and plan) of ``df``."""
    return schemas.conform(df.where(F.lit(False)), schemas.ARCHIVE_MANIFEST)


def _now(now) -> Column:
    if isinstance(now, Column):
        return now
    return F.localtimestamp() if now is None else F.lit(now).cast("timestamp_ntz")


def record_archived(manifest: DataFrame, files: DataFrame, now=None) -> DataFrame:
    """Files (``source_file``, ``log_type``, ``archive_path``) were archived; a known file is overwritten."""
    incoming = files.select("source_file", "log_type", "archive_path").withColumns(
        {"archived_at": _now(now), "status": F.lit(ARCHIVED)}
    )
    return upsert(manifest, incoming, ("log_type", "source_file"), ("archive_path", "archived_at", "status"))


def record_validation(manifest: DataFrame, counts: DataFrame, now=None) -> DataFrame:
    """Store reconciled counts (see ``archive.reconcile``, with ``log_type``) and the verdict of each known file."""
    changes = counts.select(
        "log_type",
        "source_file",
        "json_rows",
        "warehouse_rows",
        "parquet_rows",
        _now(now).alias("validated_at"),
        F.when(F.col("passed"), VALIDATED).otherwise(FAILED).alias("status"),
        F.lit(None).cast("string").alias("notes"),
    )
    return update(manifest, changes, ("log_type", "source_file"))


def record_deleted(manifest: DataFrame, files: DataFrame, now=None) -> DataFrame:
    """Files (``log_type``, ``source_file``, ``checksum``) are gone; their fingerprint stays."""
    changes = files.select("log_type", "source_file", _now(now).alias("deleted_at"), F.lit(DELETED).alias("status"), "checksum")
    return update(manifest, changes, ("log_type", "source_file"))


def record_kept(manifest: DataFrame, files: DataFrame, notes: str = KEPT_NOTE) -> DataFrame:
    """Files (``log_type``, ``source_file``) passed and were left in place on purpose."""
    changes = files.select("log_type", "source_file", F.lit(VALIDATED_KEPT).alias("status"), F.lit(notes).alias("notes"))
    return update(manifest, changes, ("log_type", "source_file"))


def safe_to_purge(manifest: DataFrame) -> DataFrame:
    """Source files whose archive is proven complete and known."""
    return manifest.where((F.col("status") == VALIDATED) & F.col("archive_path").isNotNull()).select("source_file", "log_type", "archive_path")


def last_activity(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.max(F.coalesce("deleted_at", "validated_at", "archived_at")).alias("last_activity"))
