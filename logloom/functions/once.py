"""Columns that are evaluated exactly once per row."""

from pyspark.sql import Column, DataFrame, functions as F


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add (or replace) costly columns that later filters use.

    The optimizer pushes a filter on a computed column below the projection by
    copying the expression, so a JSON parse or a chain of regular expressions
    would run twice per row. It does not look through a generator: the columns
    are therefore emitted by exploding an array of one element.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select(*kept, F.inline(F.array(row)))
