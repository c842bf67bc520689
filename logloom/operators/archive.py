"""Archive of raw lines and row-count reconciliation."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from logloom import schemas
from logloom.sources.logs import MALFORMED

PARTITIONS = ("log_type", "year", "month", "source_file")


# Partition value of files whose name has no date.
UNDATED = "unknown"

# Characters that a partition's folder name spells as % and two hexadecimal digits; % itself comes first.
_ESCAPED = "%\"#'*/:=?\\{[]^"


def _year_and_month():
    """From the file's name, which ends with its date; ``unknown`` for any other name."""
    name = F.substring_index("source_file", "/", -1)
    parts = [F.regexp_extract(name, r"(\d{4})-(\d{2})-\d{2}(?:\..*)?$", group) for group in (1, 2)]
    return tuple(F.when(part == "", UNDATED).otherwise(part) for part in parts)


def partition_path(root: str, log_type: str):
    """Where the archive of a source file lies: the folder that ``write_archive`` makes of the same columns."""
    year, month = _year_and_month()
    folder = F.col("source_file")
    for character in _ESCAPED:
        folder = F.replace(folder, F.lit(character), F.lit(f"%{ord(character):02X}"))
    return F.concat(F.lit(f"{root}/log_type={log_type}/year="), year, F.lit("/month="), month, F.lit("/source_file="), folder)


def archive_rows(checked: DataFrame, log_type: str) -> DataFrame:
    """Well-formed lines as archive rows; year and month come from the file's name."""
    year, month = _year_and_month()
    return checked.where(F.col("kind") != MALFORMED).select(
        F.col("line").alias("raw_json"),
        F.lit(log_type).alias("log_type"),
        year.alias("year"),
        month.alias("month"),
        "source_file",
    )


def write_archive(rows: DataFrame, root: str) -> None:
    """Write ZSTD Parquet; a file archived before is replaced, other files are left alone."""
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*PARTITIONS)
        .parquet(root)
    )


def read_archive(spark: SparkSession, root: str, tolerant: bool = False) -> DataFrame:
    """The archived lines. ``tolerant`` skips unreadable files, so that they show up as missing rows."""
    reader = spark.read.schema(schemas.ARCHIVE)
    return reader.option("ignoreCorruptFiles", str(tolerant).lower()).parquet(root)


def count_per_file(*tables: DataFrame) -> DataFrame:
    """Rows per source file over one or several tables (a line is in exactly one of them)."""
    counts = [t.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")) for t in tables]
    if len(counts) == 1:
        return counts[0]
    return reduce(DataFrame.unionByName, counts).groupBy("source_file").agg(F.sum("rows").alias("rows"))


def reconcile(read: DataFrame, loaded: DataFrame, archived: DataFrame) -> DataFrame:
    """Compare the three counts of each file; ``passed`` when all agree.

    The counts are stacked and summed per file rather than joined twice; a file
    missing on one side counts 0 there.
    """
    sides = {"json_rows": read, "warehouse_rows": loaded, "parquet_rows": archived}
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.select("source_file", F.col("rows").alias(name)) for name, df in sides.items()],
    )
    counts = stacked.groupBy("source_file").agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in sides])
    agree = (F.col("json_rows") == F.col("warehouse_rows")) & (F.col("json_rows") == F.col("parquet_rows"))
    return counts.withColumn("passed", agree)
