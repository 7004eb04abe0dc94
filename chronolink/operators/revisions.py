"""Histories: ordering, grouping and comparing the revisions of an article.

``revisions`` is ``(article, rev_id, ts)`` with every revision, also those without links.
``links`` is ``(article, rev_id, target, cnt)`` with targets unique per revision.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.sequence import HOT_ROWS, number_rows, number_rows_checked

# Revisions per row of ``article_history``.
HISTORY_PART = 1_000


def order_revisions(revisions: DataFrame, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Add ``seq`` and ``next_ts``: time order within the article, ties broken by ``rev_id``."""
    return number_rows(
        revisions, ["article"], ["ts", "rev_id"], lead={"next_ts": "ts"}, hot_rows=hot_rows
    )


def after(revisions: DataFrame, cutoff: Column | str) -> DataFrame:
    """Revisions strictly after ``cutoff``."""
    bound = F.lit(cutoff).cast("timestamp_ntz") if isinstance(cutoff, str) else cutoff
    return revisions.filter(F.col("ts") > bound)


def group_revisions(revisions: DataFrame) -> DataFrame:
    """One row per article: number of revisions, first and last time."""
    return revisions.groupBy("article").agg(
        F.count(F.lit(1)).alias("n_revisions"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def article_history(
    rev_links: DataFrame, *, part_size: int = HISTORY_PART, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The revisions of each article with their links, gathered in time order.

    ``rev_links`` is ``(article, rev_id, ts, links)``. A history has no size limit, so a row is always a part of
    one, ``(article, part, first_pos, last_pos, revisions)``: at most ``part_size`` consecutive revisions, with the
    1-based positions of the first and the last in the whole history. All parts in order are the history.
    """
    numbered = number_rows(rev_links, ["article"], ["ts", "rev_id"], hot_rows=hot_rows)
    part = F.floor((F.col("seq") - 1) / part_size).alias("part")
    return numbered.groupBy("article", part).agg(
        F.min("seq").alias("first_pos"),
        F.max("seq").alias("last_pos"),
        F.transform(
            F.sort_array(F.collect_list(F.struct("seq", "ts", "rev_id", "links"))),
            lambda r: F.struct(r.ts.alias("ts"), r.rev_id.alias("rev_id"), r.links.alias("links")),
        ).alias("revisions"),
    )


def link_changes(
    revisions: DataFrame, links: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Compare each revision's ``(target, cnt)`` set with that of the revision before it.

    Returns ``(article, rev_id, ts, target, cnt, change)`` with ``change`` one of ``kept``,
    ``added`` (not in the revision before, or with another count) and ``removed``.

    Each link row is put down twice, at its own revision and at the following one; what meets
    there says what changed. A group is two rows at most, whatever the length of the history.
    """
    ordered, _ = number_rows_checked(
        revisions.select("article", "rev_id", "ts"),
        ["article"],
        ["ts", "rev_id"],
        lead={"next_ts": "ts", "next_rev": "rev_id"},
        hot_rows=hot_rows,
        also=links,
    )
    here = F.struct("rev_id", "ts", F.lit(True).alias("now"))
    there = F.struct(
        F.col("next_rev").alias("rev_id"), F.col("next_ts").alias("ts"), F.lit(False).alias("now")
    )
    placed = links.join(ordered, ["article", "rev_id"]).select(
        "article", "target", "cnt", F.explode(F.array(here, there)).alias("at")
    )
    return (
        placed.filter(F.col("at.rev_id").isNotNull())
        .groupBy("article", F.col("at.rev_id").alias("rev_id"), "target", "cnt")
        .agg(
            F.first("at.ts").alias("ts"),
            F.bool_or("at.now").alias("_now"),
            F.bool_or(~F.col("at.now")).alias("_before"),
        )
        .select(
            "article",
            "rev_id",
            "ts",
            "target",
            "cnt",
            F.when(F.col("_now") & F.col("_before"), "kept")
            .when(F.col("_now"), "added")
            .otherwise("removed")
            .alias("change"),
        )
    )


def kept(changes: DataFrame) -> DataFrame:
    """Links carried over unchanged."""
    return _of(changes, "kept")


def removed(changes: DataFrame) -> DataFrame:
    """Links gone, or with another count than before."""
    return _of(changes, "removed")


def added(changes: DataFrame) -> DataFrame:
    """Links new, or with another count than before."""
    return _of(changes, "added")


def merged(changes: DataFrame) -> DataFrame:
    """Links alive after the revision: kept and added."""
    return _of(changes, "kept", "added")


def _of(changes, *kinds):
    return changes.filter(F.col("change").isin(*kinds)).drop("change")


def link_delta(
    revisions: DataFrame, links: DataFrame, *, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``link_changes`` as one row per revision with arrays ``kept``, ``removed``, ``added``, ``merged``.

    An array is as long as the links of two revisions at most. Revisions without links are kept.
    """
    pair = F.struct("target", "cnt")
    change = F.col("change")

    def gather(condition):
        return F.sort_array(F.collect_list(F.when(condition, pair)))

    sets = (
        link_changes(revisions, links, hot_rows=hot_rows)
        .groupBy("article", "rev_id")
        .agg(
            gather(change == "kept").alias("kept"),
            gather(change == "removed").alias("removed"),
            gather(change == "added").alias("added"),
            gather(change != "removed").alias("merged"),
        )
    )
    names = ["kept", "removed", "added", "merged"]
    empty = F.array().cast(sets.schema["kept"].dataType)
    return (
        revisions.select("article", "rev_id", "ts")
        .join(sets, ["article", "rev_id"], "left")
        .withColumns({name: F.coalesce(name, empty) for name in names})
    )
