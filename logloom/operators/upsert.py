"""Keyed upsert that knows who owns a column."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def upsert(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    overwrite: Sequence[str],
    earliest: Sequence[str] = (),
    defaults: dict[str, str] | None = None,
) -> DataFrame:
    """Merge ``incoming`` into ``current`` and return the new table.

    * ``overwrite``: taken from the incoming row, NULL included.
    * ``earliest``: the smaller of both values; a NULL never wins.
    * ``defaults``: kept when set, filled when NULL (new and matched rows only).
    * every other column belongs to people and is never touched.

    Rows without an incoming partner stay exactly as they are; incoming rows with
    a NULL key are ignored. One full outer join on the key.
    """
    defaults = defaults or {}
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    incoming = incoming.where(keyed).withColumn("_matched", F.lit(True))
    old, new = current.alias("old"), incoming.alias("new")
    on = reduce(lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    matched = F.col("new._matched")

    def merged(name: str):
        was = F.col(f"old.{name}")
        if name in keys:
            value = F.coalesce(was, F.col(f"new.{name}"))
        elif name in overwrite:
            value = F.when(matched, F.col(f"new.{name}")).otherwise(was)
        elif name in earliest:
            value = F.least(was, F.col(f"new.{name}"))
        elif name in defaults:
            value = F.when(matched, F.coalesce(was, F.lit(defaults[name]))).otherwise(was)
        else:
            value = was
        return value.alias(name)

    return old.join(new, on, "full_outer").select([merged(c) for c in current.columns])


def update(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Set the columns of ``changes`` on the rows of ``current`` with the same keys.

    Keys that ``current`` does not hold are ignored.
    """
    changed = [c for c in changes.columns if c not in keys]
    old, new = current.alias("old"), changes.withColumn("_matched", F.lit(True)).alias("new")
    on = reduce(lambda a, b: a & b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys])
    columns = [
        (F.when(F.col("new._matched"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) if c in changed else F.col(f"old.{c}")).alias(c)
        for c in current.columns
    ]
    return old.join(new, on, "left").select(columns)
