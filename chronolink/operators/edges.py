"""Temporal edges: ``(article, target, cnt, valid_from, valid_to)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sequence import HOT_ROWS, number_rows_split

EDGE = ["article", "target", "cnt"]
# Rows of links that one task sorts and gathers into runs, on average; a row takes some 400 to 600 bytes there.
TASK_ROWS = 500_000


def temporal_edges(
    revisions: DataFrame,
    links: DataFrame,
    *,
    include_open: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Maximal runs of consecutive revisions in which an article has a link with the same count.

    A run starts at its first revision and ends at the time of the first revision that lacks the
    link or has it with another count. A run that reaches the last revision is still open: it is
    left out, or with ``include_open`` kept with a null ``valid_to``.

    ``revisions`` is ``(article, rev_id, ts)`` with every revision, also those without links;
    ``links`` is ``(article, rev_id, target, cnt)`` with targets unique per revision.
    """
    cold, hot, articles, rows = number_rows_split(
        revisions.select("article", "rev_id", "ts"),
        ["article"],
        ["ts", "rev_id"],
        lead={"next_ts": "ts"},
        hot_rows=hot_rows,
        also=links,
    )
    keys = ["article", "rev_id"]
    if hot is None:
        return _runs(links.join(cold, keys), None, include_open, rows)
    cold = links.join(articles, "article", "left_anti").join(cold, keys)
    hot = links.join(articles, "article", "left_semi").join(hot, keys)
    return _runs(cold, None, include_open, rows).unionByName(_runs(hot, hot_rows, include_open, rows))


def temporal_edges_from_arrays(
    rev_links: DataFrame, *, include_open: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``temporal_edges`` for ``(article, rev_id, ts, links)`` with an array of links per revision.

    The array travels with its revision, so the join of links and revisions falls away.
    """
    cold, hot, _, rows = number_rows_split(
        rev_links.select("article", "rev_id", "ts", "links"),
        ["article"],
        ["ts", "rev_id"],
        lead={"next_ts": "ts"},
        hot_rows=hot_rows,
        weight=1 + F.greatest(F.coalesce(F.size("links"), F.lit(0)), F.lit(0)),
    )
    placed = [F.col("article"), F.col("seq"), F.col("ts"), F.col("next_ts"), F.inline("links")]
    edges = _runs(cold.select(*placed), None, include_open, rows)
    return edges if hot is None else edges.unionByName(_runs(hot.select(*placed), hot_rows, include_open, rows))


def _runs(placed: DataFrame, slice_revs: int | None, include_open: bool, rows: int) -> DataFrame:
    """Join consecutive ``seq`` of the same edge into runs.

    With ``slice_revs``, for hot articles, a history is cut into slices of that many revisions. Runs are built
    inside each slice; only those that touch a cut, at most two per slice, are joined across slices.

    ``rows`` is about their number. Many rows are dealt so that no task's share grows with the table.
    """
    seq = F.col("seq")
    bounds = [
        F.min("seq").alias("_start"),
        F.max("seq").alias("_end"),
        F.min("ts").alias("valid_from"),
        F.max("next_ts").alias("valid_to"),
        F.bool_or(F.col("next_ts").isNull()).alias("_open"),
    ]
    within = list(EDGE)
    if slice_revs is not None:
        placed = placed.withColumn("_slice", F.floor((seq - 1) / slice_revs))
        within.append("_slice")
    if rows > TASK_ROWS:
        # The same exchange that the window asks for, with a number of partitions that Spark does not join again.
        usual = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = placed.repartition(max(usual, -(-rows // TASK_ROWS)), *within)
    # Consecutive seq and consecutive row numbers differ by a constant.
    island = seq - F.row_number().over(Window.partitionBy(*within).orderBy("seq"))
    runs = placed.withColumn("_island", island).groupBy(*within, "_island").agg(*bounds)

    if slice_revs is not None:
        cut_before = (F.col("_start") == F.col("_slice") * slice_revs + 1) & (F.col("_slice") > 0)
        cut_after = F.col("_end") == (F.col("_slice") + 1) * slice_revs
        # -1 gathers the runs at cuts; all others stay apart, slice by slice.
        lane = F.when(cut_before | cut_after, F.lit(-1)).otherwise(F.col("_slice"))
        runs = runs.withColumn("_lane", lane)
        along = Window.partitionBy(*EDGE, "_lane").orderBy("_start")
        joins = F.coalesce(F.col("_start") == F.lag("_end").over(along) + 1, F.lit(False))
        runs = (
            runs.withColumn("_starts", (~joins).cast("int"))
            .withColumn("_chain", F.sum("_starts").over(along))
            .groupBy(*EDGE, "_lane", "_chain")
            .agg(
                F.min("valid_from").alias("valid_from"),
                F.max("valid_to").alias("valid_to"),
                F.bool_or("_open").alias("_open"),
            )
        )

    if include_open:
        valid_to = F.when(~F.col("_open"), F.col("valid_to"))
        return runs.select(*EDGE, "valid_from", valid_to.alias("valid_to"))
    return runs.filter(~F.col("_open")).select(*EDGE, "valid_from", "valid_to")


def distinct_links(revisions: DataFrame, links: DataFrame) -> DataFrame:
    """Each ``(article, target, cnt)`` once, with the time it was first seen."""
    return (
        links.join(revisions.select("article", "rev_id", "ts"), ["article", "rev_id"])
        .groupBy(*EDGE)
        .agg(F.min("ts").alias("valid_from"))
    )
