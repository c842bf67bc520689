"""The warehouse: named tables in a shared folder.

Facts grow by partition and are replaced partition by partition, so loading a
file again is harmless. Registries are small and always rewritten whole: each
write makes a new numbered version, and readers take the newest complete one,
so a table is never overwritten while it is being read.
"""

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from logloom.constants import EXPORTED_TABLES
from logloom.schemas import TABLES, conform
from logloom.session import configure

_DONE = "_SUCCESS"
_RENAMED = {"instrumentation_gap_catalog": {"message_pattern": "raw_pattern"}}


def inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` of several tables in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


class Warehouse:
    """Reads, writes and lists the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = configure(spark)
        self.root = root.rstrip("/")

    # --- files ---------------------------------------------------------------------------

    def _fs(self, path: str):
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        target = hadoop.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target

    def has(self, path: str) -> bool:
        """Whether a file or folder exists in the shared storage."""
        fs, target = self._fs(path)
        return fs.exists(target)

    def _size(self, path: str) -> int:
        fs, target = self._fs(path)
        return fs.getContentSummary(target).getLength()

    def _versions(self, table: str) -> list[int]:
        """Complete versions of a registry, oldest first."""
        fs, target = self._fs(f"{self.root}/{table}")
        if not fs.exists(target):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(target)]
        numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
        return sorted(n for n in numbers if self.has(f"{self._version(table, n)}/{_DONE}"))

    def _version(self, table: str, number: int) -> str:
        return f"{self.root}/{table}/version={number}"

    # --- reading -------------------------------------------------------------------------

    def exists(self, table: str) -> bool:
        if TABLES[table][1]:
            return self.has(f"{self.root}/{table}")
        return bool(self._versions(table))

    def read(self, table: str) -> DataFrame:
        """The table, or an empty one with its columns while nothing was written."""
        schema, partitions = TABLES[table]
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        if partitions:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        stored = self.spark.read.parquet(self._version(table, self._versions(table)[-1]))
        return conform(stored, schema, _RENAMED.get(table))

    def register_views(self, tables=EXPORTED_TABLES) -> DataFrame:
        """Make the tables available to SQL and report their row counts."""
        frames = {t: self.read(t) for t in tables}
        for name, df in frames.items():
            df.createOrReplaceTempView(name)
        return inventory(frames)

    def inventory(self) -> DataFrame:
        """Row counts of all tables that were written; NULL for a table that can't be read."""
        counts = []
        for table in TABLES:
            if self.exists(table):
                try:
                    counts.append((table, self.read(table).count()))
                except (PySparkException, Py4JError):
                    counts.append((table, None))
        return self.spark.createDataFrame(counts, "table string, rows bigint")

    # --- writing -------------------------------------------------------------------------

    def append(self, table: str, rows: DataFrame, shuffled: bool = False) -> None:
        """Add rows of whole source files; rows of the same files and days are replaced.

        Tasks that read files hold few partitions each and write them as they are.
        ``shuffled`` rows are mixed: they are gathered by partition first, else every
        task would leave a small file in every partition. The rebalancing splits a
        partition that is large and merges small ones.
        """
        schema, partitions = TABLES[table]
        if shuffled:
            rows = rows.hint("rebalance", *[F.col(c) for c in partitions])
        (
            rows.select(*schema.names)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "zstd")
            .partitionBy(*partitions)
            .parquet(f"{self.root}/{table}")
        )

    def add(self, table: str, rows: DataFrame) -> None:
        """Add rows and leave all earlier ones as they are."""
        schema, partitions = TABLES[table]
        rows.select(*schema.names).write.mode("append").option("compression", "zstd").partitionBy(*partitions).parquet(f"{self.root}/{table}")

    @contextmanager
    def kept(self, rows: DataFrame) -> Iterator[DataFrame]:
        """The rows, computed once, for as long as a step needs them: a table of the shared storage that goes afterwards."""
        path = f"{self.root}/steps/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        try:
            yield self.spark.read.schema(rows.schema).parquet(path)
        finally:
            fs, target = self._fs(path)
            fs.delete(target, True)

    def next_batch(self) -> int:
        """A number above those of all ledger entries."""
        last = self.read("file_ledger").agg(F.max("batch")).first()[0]
        return (last or 0) + 1

    def note(self, step: str, files: DataFrame, counts: DataFrame | None = None) -> None:
        """Enter into the ledger how many rows a step has stored of each of ``files``; without ``counts`` they are taken back."""
        columns = ["source_file", *(c for c in ("length", "modified_at") if c in files.columns)]
        entries = files.select(*columns)
        if counts is None:
            entries = entries.withColumn("rows", F.lit(None).cast("bigint"))
        else:
            entries = entries.join(counts, "source_file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
        self.enter(step, entries)

    def enter(self, step: str, entries: DataFrame) -> None:
        """Add ledger entries (``source_file``, ``rows``, and the file's length and time where known)."""
        absent = {f.name: F.lit(None).cast(f.dataType) for f in TABLES["file_ledger"][0] if f.name in ("length", "modified_at")}
        absent = {name: column for name, column in absent.items() if name not in entries.columns}
        stamped = entries.withColumns({**absent, "step": F.lit(step), "batch": F.lit(self.next_batch()).cast("bigint"), "recorded_at": F.localtimestamp()})
        self.add("file_ledger", stamped.hint("rebalance"))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Write the next version of a registry."""
        number = max(self._versions(table), default=0) + 1
        rows.write.mode("overwrite").option("compression", "zstd").parquet(self._version(table, number))

    def export(self, target: str, tables=EXPORTED_TABLES) -> DataFrame:
        """Write the report tables as ZSTD Parquet; missing ones are skipped.

        Returns ``(table, rows, bytes)`` of what was written.
        """
        written = [t for t in tables if self.exists(t)]
        for table in written:
            self.read(table).write.mode("overwrite").option("compression", "zstd").parquet(f"{target}/{table}")
        if not written:
            return self.spark.createDataFrame([], "table string, rows bigint, bytes bigint")
        counts = inventory({t: self.spark.read.parquet(f"{target}/{t}") for t in written})
        sizes = self.spark.createDataFrame([(t, self._size(f"{target}/{t}")) for t in written], "table string, bytes bigint")
        return counts.join(sizes, "table")
