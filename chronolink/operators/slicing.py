"""Slices of the page order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sequence import sorted_ranges

# Up to this many rows Spark's top-k keeps only skip + take rows per task.
TOP_K_ROWS = 10_000


def page_slice(
    pages: DataFrame, order: Sequence[str], *, skip: int = 0, take: int | None = None
) -> DataFrame:
    """Skip the first ``skip`` rows in ``order``, then take ``take`` rows, or all that follow.

    A slice further on is cut from the table sorted into ranges: the sizes of the ranges, one number each, tell
    where it begins and ends, and only ranges that it touches are read again.
    """
    if take is not None and skip + take <= TOP_K_ROWS:
        return pages.orderBy(*order).offset(skip).limit(take)
    ranges = sorted_ranges(pages, order)
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).orderBy("_range").collect()
    wanted = F.col("_id") >= _id_at(sizes, skip)
    if take is not None:
        wanted &= F.col("_id") < _id_at(sizes, skip + take)
    return ranges.filter(wanted).select(*pages.columns)


def _id_at(sizes: list, position: int) -> int:
    """The ``_id`` of the row at a position from 0, or one past all others."""
    for number, size in sizes:
        if position < size:
            return (number << 33) + position
        position -= size
    return (sizes[-1][0] + 1 << 33) if sizes else 0
