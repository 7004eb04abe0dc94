"""Links of pages and revisions. Everything here is narrow: nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.anchors import (
    anchors,
    is_basic_link,
    is_strict_link,
    without_anchors,
    without_tags,
)
from ..functions.once import with_columns_once
from ..functions.text import literal_counts, unescape_html


def flat_links(pages: DataFrame, *, kind: str = "wikitext") -> DataFrame:
    """One row per link occurrence: ``(page_title, target, cnt)`` with ``cnt`` 1.

    ``pages`` has ``title`` and ``text``. Links to user pages and outside links are left out.
    """
    links = F.filter(anchors("text", kind), lambda a: is_basic_link(a.title, a["class"]))
    return pages.select(F.col("title").alias("page_title"), F.explode(links).alias("_link")).select(
        "page_title",
        unescape_html(F.col("_link.title")).alias("target"),
        F.lit(1).alias("cnt"),
    )


def with_strict_links(df: DataFrame, *, kind: str, text: str = "text") -> DataFrame:
    """Add ``targets``: the titles of all strict links of the text, in order, entities replaced."""
    links = F.filter(anchors(text, kind), lambda a: is_strict_link(a.title, a["class"]))
    titles = F.transform(links, lambda a: unescape_html(a.title))
    return with_columns_once(df, {"targets": F.filter(titles, lambda t: t != "")})


def with_anchor_counts(df: DataFrame, *, kind: str = "wikitext", text: str = "text") -> DataFrame:
    """Add ``links``: ``ARRAY<STRUCT<target, anchors>>``, one entry per target of a strict link.

    A row whose text is null or has no links gets an empty array.
    """
    # Sorted, equal targets are neighbours: a run starts where a target differs from the one before
    # and lasts until the next start. This counts in n log n without leaving the row.
    positions = F.when(F.col("_n") > 0, F.sequence(F.lit(0), F.col("_n") - 1))
    run = lambda at, k: F.struct(
        F.get("_sorted", at).alias("target"),
        (F.coalesce(F.get("_starts", k + 1), F.col("_n")) - at).cast("long").alias("anchors"),
    )
    counted = (
        with_strict_links(df, kind=kind, text=text)
        .withColumn("_sorted", F.sort_array("targets"))
        .withColumn("_n", F.size("_sorted"))
        .withColumn(
            "_starts",
            F.filter(
                F.coalesce(positions, F.array().cast("array<int>")),
                lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
            ),
        )
    )
    kept = [c for c in df.columns if c != "links"]
    return with_columns_once(counted, {"links": F.transform("_starts", run)}).select(*kept, "links")


def with_link_counts(
    df: DataFrame, *, kind: str = "wikitext", text: str = "text", count_in: str = "markup"
) -> DataFrame:
    """Add ``links``: ``ARRAY<STRUCT<target, anchors, mentions, cnt>>``, one entry per target.

    ``anchors`` counts the links to the target, ``mentions`` its literal occurrences in the text
    with all links cut out, ``cnt`` both. ``count_in="markup"`` searches the text as it is,
    ``"text"`` without HTML tags. A row whose text is null or has no links gets an empty array.
    """
    if count_in not in ("markup", "text"):
        raise ValueError(f"count_in must be 'markup' or 'text', not {count_in!r}")
    rest = without_anchors(text, kind)
    if count_in == "text":
        rest = without_tags(rest)

    total = F.transform(
        "links",
        lambda link, i: F.struct(
            link.target.alias("target"),
            link.anchors.alias("anchors"),
            F.get("_mentions", i).alias("mentions"),
            (link.anchors + F.get("_mentions", i)).alias("cnt"),
        ),
    )
    counted = with_anchor_counts(df, kind=kind, text=text)
    counted = with_columns_once(counted, {"_rest": F.when(F.size("links") > 0, rest)})
    counted = with_columns_once(counted, {"_mentions": literal_counts("_rest", F.col("links.target"))})
    kept = [c for c in df.columns if c != "links"]
    return with_columns_once(counted, {"links": total}).select(*kept, "links")


def page_links(pages: DataFrame, *, kind: str = "wikitext", count_in: str = "markup") -> DataFrame:
    """One row per page, ``(title, links)`` with ``links ARRAY<STRUCT<target, cnt>>``, also if empty."""
    pair = F.transform(
        "links", lambda r: F.struct(r.target.alias("target"), r.cnt.alias("cnt"))
    )
    return with_link_counts(pages, kind=kind, count_in=count_in).select(
        "title", pair.alias("links")
    )
