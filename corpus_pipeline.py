"""A corpus pipeline: each stage works on all rows that the one before kept, written as Parquet and read again between."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logloom.llm import mixing, nbsvm, pieces, secretscan, similar
from logloom.llm.common import stored, table
from logloom.llm.queries import quality_model, tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.3 go; null and empty texts are scored like any other."""
    model = quality_model(docs, table(spark, sf_dir, "labels"))
    scored = nbsvm.score(docs, model, keep=tuple(docs.columns), name="__quality")
    return scored.filter("__quality >= 0.3").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (0.8 of five-word shingles shared), one row stays: the one with the smallest doc_id.

    Groups are of texts, so rows that share an id but not a text are judged apart; of rows equal in both one stays. A row without
    a doc_id stays only where its group has no row with one. Null and empty texts are equal.
    """
    groups = similar.groups(docs, shingle=5, least=0.8)
    rows = docs.select("doc_id", similar.node_of("text").alias("node"))
    counted = rows.groupBy("node", "doc_id").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "node", "n")).alias("first")
    chosen = stored(counted.join(groups, "node").groupBy("root").agg(first).select("first.*"), "rows-kept")

    # Names that no column of the caller's has.
    longest = "_" * max(map(len, docs.columns))
    id_, node = f"{longest}_id", f"{longest}_node"

    def kept(some: DataFrame) -> DataFrame:
        some = some.select(F.col("doc_id").alias(id_), F.col("node").alias(node))
        return docs.join(some, F.col("doc_id").eqNullSafe(F.col(id_)) & (similar.node_of("text") == F.col(node)), "left_semi")

    # Only rows that repeat an id and a text have to be brought together.
    return kept(chosen.filter("n = 1")).unionAll(kept(chosen.filter("n > 1")).dropDuplicates(["doc_id", "text"]))


def secret_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced by a mark, and n_chars follows where the table has it.

    A null text stays null, an empty one empty; repeated rows are rows of their own.
    """
    clean = secretscan.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: each document as often as the mix takes it, never or up to three times."""
    return mixing.take(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and whether they decode to its text."""
    return pieces.encode(docs, tokenizer("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_free),
    ("mixing to target weights", mixed),
    ("SentencePiece encoding", encoded),
]

#: The fitted classifier and XXH64 fingerprints can't be written in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{i}")
    return docs
