import pytest
from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet consectetur " * 60_000  # more than two blocks of any operator


@pytest.fixture(scope="session")
def long_text():
    return LONG


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows, and extra columns whose names
    the operators use themselves."""
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
            *(T.StructField(n, T.StringType()) for n in ("id", "score", "fingerprint", "size", "label", "ids", "spans")),
        ]
    )
    extra = ("x",) * 7
    rows = [
        (1, None, "en", "a", 0, *extra),
        (2, "", None, None, None, *extra),
        (3, " \t\n", "en", "a", 3, *extra),
        (None, "a row without an id has words too, more than ten of them in all", "en", "b", 10, *extra),
        (5, "the same words in the same order twice", "en", "b", 10, *extra),
        (5, "the same words in the same order twice", "en", "b", 10, *extra),
        (6, "the same words in the same order twice", "de", "b", 10, *extra),
        (7, LONG, "en", None, len(LONG), *extra),
        (8, "!!! 123 ???", "en", "c", 11, None, None, None, None, None, None, None),
    ]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
