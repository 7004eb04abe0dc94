"""Keeping costly columns from being worked out more than once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for costly expressions.

    The optimizer pushes a filter on a plain column below it by repeating the column's expression in
    the filter. It does not push filters below a generator, so the columns come out of one.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(row)))
