"""The ledger of files: what each step has stored of each log file.

A step is named after the table it fills. An entry is added after the step's rows
were written, so a step that died half way has no entry and is done again; an entry
without rows takes an earlier one back. The newest entry (highest batch) counts. What
a step still has to do follows from the entries alone, without counting in the tables.
"""

from pyspark.sql import DataFrame, functions as F

#: Files that one round of a step works on at most: bounds the names that are broadcast or, for reading logs, listed.
FILES_PER_ROUND = 10_000


def latest(ledger: DataFrame, step: str) -> DataFrame:
    """``(source_file, rows, batch)``: each file's newest entry of a step; ``rows`` is NULL where it was taken back."""
    newest = F.max(F.struct("batch", F.col("rows").isNull().alias("gone"), "rows")).alias("newest")
    entries = ledger.where(F.col("step") == step).groupBy("source_file").agg(newest)
    return entries.select("source_file", F.col("newest.rows").alias("rows"), F.col("newest.batch").alias("batch"))


def done(ledger: DataFrame, step: str) -> DataFrame:
    return latest(ledger, step).where(F.col("rows").isNotNull())


def pending(ledger: DataFrame, source: str, target: str) -> DataFrame:
    """Files that ``source`` has and ``target`` has not, or had before ``source`` stored them again."""
    have, made = done(ledger, source).alias("have"), done(ledger, target).alias("made")
    same = (F.col("have.source_file") == F.col("made.source_file")) & (F.col("made.batch") > F.col("have.batch"))
    return have.join(made, same, "left_anti")


def unknown(ledger: DataFrame, step: str, listing: DataFrame) -> DataFrame:
    """Files of a listing that a step has not stored."""
    return listing.join(done(ledger, step), "source_file", "left_anti")


def altered(ledger: DataFrame, step: str, listing: DataFrame) -> DataFrame:
    """Files whose length or time of change is not the one they were loaded with."""
    of_step = ledger.where((F.col("step") == step) & F.col("length").isNotNull())
    loaded = of_step.groupBy("source_file").agg(F.max_by(F.struct("length", "modified_at"), "batch").alias("was"))
    now = listing.select("source_file", "length", "modified_at")
    changed = (F.col("was.length") != F.col("length")) | (F.col("was.modified_at") != F.col("modified_at"))
    return now.join(loaded, "source_file").where(changed).select(
        "source_file", F.col("was.length").alias("loaded_length"), "length", F.col("was.modified_at").alias("loaded_at"), "modified_at"
    )


def corrections(ledger: DataFrame, step: str, want: DataFrame, have: DataFrame) -> DataFrame:
    """``(source_file, rows)`` of the entries that a step lacks, given the rows per file it should have and has.

    Where the two agree the entry holds them; where they don't it takes the file's earlier entry back.
    """
    sides = want.select("source_file", F.col("rows").alias("want")).unionByName(
        have.select("source_file", F.col("rows").alias("have")), allowMissingColumns=True
    )
    entries = latest(ledger, step).select("source_file", F.col("rows").alias("known"), F.lit(True).alias("entered"))
    stacked = sides.unionByName(entries, allowMissingColumns=True)
    counts = stacked.groupBy("source_file").agg(
        F.coalesce(F.sum("want"), F.lit(0)).alias("want"),
        F.coalesce(F.sum("have"), F.lit(0)).alias("have"),
        F.max("known").alias("known"),
        F.coalesce(F.bool_or("entered"), F.lit(False)).alias("entered"),
    )
    right = counts.withColumn("rows", F.when(F.col("want") == F.col("have"), F.col("have")))
    return right.where(~F.col("entered") | ~F.col("rows").eqNullSafe(F.col("known"))).select("source_file", "rows")
