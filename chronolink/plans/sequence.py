"""Row numbers within keys that hold up when one key has a large share of all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import stage

# A key with more rows than this is numbered by sorted ranges instead of by one window task. A row
# may carry an array of hundreds of links, so the bound is on the low side.
HOT_ROWS = 100_000


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lead: Mapping[str, str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``seq``, the 1-based position of each row among the rows of its key.

    ``lead`` maps new column names to columns whose value in the following row is wanted.
    Without ``keys`` the whole table is numbered.
    """
    return number_rows_checked(df, keys, order, lead=lead, hot_rows=hot_rows)[0]


def number_rows_checked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lead: Mapping[str, str] | None = None,
    hot_rows: int = HOT_ROWS,
    weight: Column | None = None,
    also: DataFrame | None = None,
) -> tuple[DataFrame, bool]:
    """As ``number_rows``, with a flag saying whether any key has more than ``hot_rows`` rows.

    ``weight`` is what a row counts where it stands for several, as with an array that is taken apart later;
    rows of ``also``, which are joined to the numbered ones later, count too.

    The check is one pre-aggregated count that brings a single number to the driver. ``df`` is
    evaluated more than once, so hand over a table or a staged result, not a dump scan.
    """
    if not keys:
        return _number_by_range(df, [], order, dict(lead or {})), True
    cold, hot, *_ = number_rows_split(df, keys, order, lead=lead, hot_rows=hot_rows, weight=weight, also=also)
    return (cold, False) if hot is None else (cold.unionByName(hot), True)


def number_rows_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    lead: Mapping[str, str] | None = None,
    hot_rows: int = HOT_ROWS,
    weight: Column | None = None,
    also: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame | None, DataFrame | None, int]:
    """As ``number_rows_checked``, with the rows of other keys, the rows of hot keys and the hot keys apart, and all rows
    that were counted.

    Hot rows and keys are None where no key is hot, so that what is done for hot keys is done to their rows only.
    """
    lead = dict(lead or {})
    counted = df.select(*keys, (F.lit(1) if weight is None else weight).cast("long").alias("_rows"))
    if also is not None:
        counted = counted.unionByName(also.select(*keys, F.lit(1).cast("long").alias("_rows")))
    sizes = counted.groupBy(*keys).agg(F.sum("_rows").alias("_rows"))
    largest, total = (n or 0 for n in sizes.agg(F.max("_rows"), F.sum("_rows")).first())
    if largest <= hot_rows:
        return _number_by_window(df, keys, order, lead), None, None, total

    # At most (all rows / hot_rows) keys are hot. The table is staged, so Spark knows its size and
    # broadcasts it only below spark.sql.autoBroadcastJoinThreshold.
    hot = stage(sizes.filter(F.col("_rows") > hot_rows).select(*keys), "hot-keys")
    cold_rows = _number_by_window(df.join(hot, list(keys), "left_anti"), keys, order, lead)
    return cold_rows, _number_by_range(df.join(hot, list(keys), "left_semi"), keys, order, lead), hot, total


def _number_by_window(df, keys, order, lead):
    window = Window.partitionBy(*keys).orderBy(*order)
    added = {"seq": F.row_number().over(window).cast("long")}
    added |= {name: F.lead(source).over(window) for name, source in lead.items()}
    return df.withColumns(added)


def sorted_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The table sorted into ranges and written, with ``_id``, ``_range`` and ``_at``, the position from 0 in the range.

    ``_id`` has the documented layout: the range above, the position in the low 33 bits. It rises with the order, so a
    filter on it reads only files and row groups that it fits.
    """
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranges.withColumn("_id", F.monotonically_increasing_id()), "ranges").withColumns(
        {"_range": F.shiftright("_id", 33), "_at": F.col("_id").bitwiseAND((1 << 33) - 1)}
    )


def _number_by_range(df, keys, order, lead):
    """Sort by (keys, order) into ranges, number inside each range, then add what precedes it.

    The ranges are cut by sampling, so they are written down before two branches rely on them.
    No task holds more than one range, however large a key is.
    """
    ranges = sorted_ranges(df, [*keys, *order])
    group = ["_range", *keys]

    first_values = F.struct(F.lit(1).alias("_"), *[F.col(c).alias(n) for n, c in lead.items()])
    parts = ranges.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_size"),
        F.min("_at").alias("_from"),
        *([F.min_by(first_values, "_at").alias("_first")] if lead else []),
    )
    # One row per range and key, so this window is bounded by the number of ranges. Staged, Spark
    # knows how small the table is and need not shuffle the rows to join it.
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_range")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    parts = stage(
        parts.select(
            *group,
            (F.col("_from") + F.col("_size") - 1).alias("_to"),
            (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_from") + 1).alias("_shift"),
            *([F.lead("_first").over(along).alias("_next")] if lead else []),
        ),
        "range-sizes",
    )

    numbered = ranges
    if lead:
        inside = Window.partitionBy(*group).orderBy("_at")
        numbered = numbered.withColumns(
            {f"_lead_{name}": F.lead(source).over(inside) for name, source in lead.items()}
        )
    at_end = F.col("_at") == F.col("_to")
    return numbered.join(parts, group).select(
        *df.columns,
        (F.col("_at") + F.col("_shift")).alias("seq"),
        *[
            F.when(at_end, F.col(f"_next.{name}")).otherwise(F.col(f"_lead_{name}")).alias(name)
            for name in lead
        ],
    )
