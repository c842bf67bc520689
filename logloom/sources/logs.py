"""JSON-lines log files -> checked lines.

One scan decides for every line whether it is a trace, a standalone event or
malformed; later steps select a kind instead of reading the text again.
"""

import re
from functools import reduce
from itertools import takewhile
from operator import add

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logloom.constants import API_FIELDS, LINE_WHITESPACE, TRACE_KEY
from logloom.functions import once, record, subtree

TRACE, EVENT, MALFORMED = "trace", "event", "malformed"

# Second element of the array that a line is wrapped into. Reading it back proves
# that the line ended where its document ended (the parser ignores trailing text).
_END_OF_LINE = "<end of log line>"

_ID_KEYS = [key for name, key, kind in API_FIELDS if kind == "bigint" and name.endswith("_id")]

# Copies of one line that a single task writes out again.
COPIES_PER_TASK = 65536


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def root_of(spark: SparkSession, pattern: str) -> str:
    """The log root of a glob: its folders in front of the first wildcard, as the path part of a URI."""
    fixed = pattern.rstrip("/").split("/")
    plain = len(list(takewhile(lambda part: not re.search(r"[*?\[{]", part), fixed)))
    root = "/".join(fixed[:plain])
    fs, target = _file_system(spark, root or "/")
    if plain == len(fixed) and not (fs.exists(target) and fs.getFileStatus(target).isDirectory()):
        target = target.getParent()
    return fs.makeQualified(target).toUri().getRawPath().rstrip("/")


def file_key(root: str, path: str = "_metadata.file_path") -> Column:
    """What a file is known by: its path below the log root. Files of one name in two folders are two files."""
    whole = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    below = F.when(whole.startswith(f"{root}/"), F.substring(whole, len(root) + 2, 1 << 20)).otherwise(whole)
    return F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B")))


def scan_lines(spark: SparkSession, paths, root: str) -> DataFrame:
    """``(source_file, line)`` of every non-blank line, trimmed; files are named below ``root``."""
    return trimmed(spark.read.text(paths), root)


def trimmed(text: DataFrame, root: str) -> DataFrame:
    lines = text.select(file_key(root).alias("source_file"), F.btrim("value", F.lit(LINE_WHITESPACE)).alias("line"))
    return lines.where(F.col("line") != "")


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``doc`` (VARIANT) and ``kind``; a malformed line keeps a NULL ``doc``.

    A good line holds exactly one JSON object and nothing behind it.
    """
    wrapped = F.concat(F.lit("["), F.col("line"), F.lit(f',"{_END_OF_LINE}"]'))
    parsed = lines.withColumn("_parsed", F.try_parse_json(wrapped))
    complete = F.col("line").startswith("{") & (F.try_variant_get("_parsed", "$[1]", "string") == _END_OF_LINE)
    documents = parsed.withColumn("doc", F.when(complete, F.try_variant_get("_parsed", "$[0]", "variant")))
    # Nearly every trace is an object, which is seen without building its tree anew.
    kind = (
        F.when(F.col("doc").isNull(), MALFORMED)
        .when(F.try_variant_get("doc", f'$["{TRACE_KEY}"]', f"struct<`{TRACE_KEY}`: boolean>").isNotNull(), TRACE)
        .when(subtree(F.col("doc"), TRACE_KEY).isNotNull(), TRACE)
        .otherwise(EVENT)
    )
    return once(documents.drop("_parsed"), {"doc": F.col("doc"), "kind": kind})


def number_copies(lines: DataFrame) -> DataFrame:
    """Number the identical lines of a file: add ``occurrence`` = 1..n.

    Identical lines are interchangeable, so they are counted (map-side, which
    folds a hot line into one row per task before the shuffle) and written out
    again, rather than ranked in one window task. A line with very many copies
    is cut into chunks that are spread over the cluster first.
    """
    counted = lines.groupBy("source_file", "line").agg(F.count(F.lit(1)).alias("n"))
    ordinary = counted.where(F.col("n") <= COPIES_PER_TASK).withColumn("first", F.lit(1).cast("bigint"))
    heavy = (
        counted.where(F.col("n") > COPIES_PER_TASK)
        .withColumn("first", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"), F.lit(COPIES_PER_TASK).cast("bigint"))))
        .repartition("source_file", "line", "first")
    )
    last = F.least(F.col("first") + (COPIES_PER_TASK - 1), F.col("n"))
    return ordinary.unionByName(heavy).select(
        "source_file", "line", F.explode(F.sequence(F.col("first"), last)).alias("occurrence")
    )


def with_raw_id(numbered: DataFrame) -> DataFrame:
    """Add the stable row id: a digest of file, line and occurrence.

    Reading the same file again gives the same ids, whatever the partitioning.
    """
    identity = F.concat_ws("\n", "source_file", "line", F.col("occurrence").cast("string"))
    return numbered.withColumn("raw_id", F.sha2(identity, 256))


def raw_table(lines: DataFrame, identified: bool) -> DataFrame:
    """Rows of a raw table: documents, plus the text of malformed lines.

    ``identified`` adds the row ids that trace parsing needs (one shuffle);
    without it the rows stay in the tasks that read them.
    """
    if identified:
        lines = with_raw_id(number_copies(lines))
    else:
        lines = lines.withColumn("raw_id", F.lit(None).cast("string"))
    kept_text = F.when(F.col("kind") == MALFORMED, F.col("line")).alias("line")
    return parse_lines(lines).select("raw_id", "doc", kept_text, "kind", "source_file")


def traces(raw: DataFrame) -> DataFrame:
    """Trace rows of the raw Cobrand table: the tree and the time of its line."""
    return raw.where(F.col("kind") == TRACE).select(
        "source_file",
        subtree(F.col("doc"), TRACE_KEY).alias("trace"),
        F.try_variant_get("doc", "$.timestamp", "string").alias("trace_timestamp"),
        "raw_id",
    )


def standalone(raw: DataFrame) -> DataFrame:
    """Standalone rows of the raw Cobrand table."""
    return raw.where(F.col("kind") == EVENT).select("source_file", "doc")


def documents(raw: DataFrame) -> DataFrame:
    """Every well-formed row (the API side knows no traces)."""
    return raw.where(F.col("kind") != MALFORMED).select("source_file", "doc")


def quality_report(raw: DataFrame) -> DataFrame:
    """Per file: good and malformed lines, and ids that are given but no number, which the facts hold as NULL."""
    ids = record(F.col("doc"), dict.fromkeys(_ID_KEYS, "string"))
    numbers = record(F.col("doc"), dict.fromkeys(_ID_KEYS, "bigint"))
    read = raw.select("source_file", "kind", ids.alias("given"), numbers.alias("read"))
    unreadable = [F.col(f"given.`{k}`").isNotNull() & F.col(f"read.`{k}`").isNull() for k in _ID_KEYS]
    return read.groupBy("source_file").agg(
        F.count_if(F.col("kind") == TRACE).alias("traces"),
        F.count_if(F.col("kind") == EVENT).alias("events"),
        F.count_if(F.col("kind") == MALFORMED).alias("malformed"),
        reduce(add, [F.count_if(c) for c in unreadable]).alias("unreadable_ids"),
    )


def unreadable_files(spark: SparkSession, paths: list[str]) -> list[tuple[str, str]]:
    """``(path, reason)`` of the files that can't be read to their end, found by halving the list."""
    try:
        spark.read.text(paths).agg(F.count(F.lit(1))).collect()
        return []
    except (PySparkException, Py4JError) as error:
        if len(paths) == 1:
            return [(paths[0], str(error).strip().splitlines()[0][:500])]
    half = len(paths) // 2
    return unreadable_files(spark, paths[:half]) + unreadable_files(spark, paths[half:])


def rows_per_file(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")).orderBy("source_file")


def list_files(spark: SparkSession, pattern: str) -> DataFrame:
    """``(path, source_file, length, modified_at)`` of the files matching a glob; contents are not read. None may match."""
    fs, target = _file_system(spark, pattern)
    if not fs.globStatus(target):
        return spark.createDataFrame([], "path string, source_file string, length bigint, modified_at timestamp")
    files = spark.read.format("binaryFile").load(pattern)
    key = file_key(root_of(spark, pattern)).alias("source_file")
    return files.select("path", key, "length", F.col("modificationTime").alias("modified_at"))


def new_files(listing: DataFrame, known: DataFrame) -> DataFrame:
    """Files of a listing that no row of ``known`` came from."""
    return listing.join(known.select("source_file").distinct(), "source_file", "left_anti")


def fingerprints(spark: SparkSession, pattern: str) -> DataFrame:
    """``(source_file, checksum)``: SHA-256 of each file's bytes."""
    key = file_key(root_of(spark, pattern)).alias("source_file")
    return spark.read.format("binaryFile").load(pattern).select(key, F.sha2("content", 256).alias("checksum"))
