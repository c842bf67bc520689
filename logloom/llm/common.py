"""What the operators of this package share: stored intermediate tables, the hold-out rule, blocks of texts."""

import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, in Java's and Python's regular expressions alike.
WORD = r"[^\x20\x09-\x0D]+"

#: Batches that Python workers get: so many rows and bytes at most (one longer text still travels whole).
_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


#: The folder that holds the package. Workers that share it can import from there; elsewhere the package is installed.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the batches of Python workers and let them import this package; the results don't depend on it."""
    for key, value in _BATCHES.items():
        spark.conf.set(key, value)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; one of our own only where that is unset."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = os.path.join(tempfile.gettempdir(), "logloom-shared")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: computed once, and safe when executors go.

    The table stays until the folder is cleaned, since lazy results still read it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/logloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str | Column, remainder: int = 0) -> Column:
    """True where crc32 of the id as text leaves that remainder by 5. A row without an id is never learned from: true."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == remainder, F.lit(True))


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def blocks(values: list, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``rows`` rows and ``size`` bytes or characters; a longer value has its own range."""
    start, total = 0, 0
    for i, value in enumerate(values):
        n = len(value) if value is not None else 0
        if i > start and (i - start == rows or total + n > size):
            yield start, i
            start, total = i, 0
        total += n
    if values:
        yield start, len(values)


def word_chunks(text: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A long text in pieces that end at white space, so that no word is cut (a longer word stays whole)."""
    start = 0
    while start < len(text):
        stop = start + size
        if stop < len(text):
            while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
                stop += 1
        yield text[start:stop]
        start = stop


class Memo(dict):
    """What was computed from a short text, kept for when it comes again.

    When it has grown to ``most`` texts it begins anew and looks in the last generation first, so that texts in use stay.
    """

    def __init__(self, compute, most: int = 1 << 18):
        super().__init__()
        self.compute, self.most, self.last = compute, most, {}

    def __missing__(self, text: str):
        found = self.last.get(text)
        if found is None:
            found = self.compute(text)
        if found is not None and len(text) <= 64:
            if len(self) >= self.most:
                self.last = dict(self)
                self.clear()
            self[text] = found
        return found
