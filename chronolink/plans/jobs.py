"""End-to-end jobs on dumps. Intermediate tables are written to the staging folder; no data is collected."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.edges import temporal_edges_from_arrays
from ..operators.links import flat_links, page_links, with_link_counts
from ..operators.pages import parse_pages, parse_pages_with_key, parse_redirects
from ..sinks.write import write_edges
from ..sources.dump import scan_pages, scan_revisions
from .sequence import HOT_ROWS
from .staging import staging_scope

Paths = str | Sequence[str]


def revision_links(
    spark: SparkSession,
    path: Paths,
    *,
    kind: str = "wikitext",
    count_in: str = "markup",
    min_ts: str | None = None,
    name_regex: str | None = None,
) -> DataFrame:
    """``(article, rev_id, ts, links, corrupt)`` of a history dump, text dropped in the scan task."""

    def narrow(revisions: DataFrame) -> DataFrame:
        counted = with_link_counts(revisions, kind=kind, count_in=count_in)
        pairs = F.transform(
            "links", lambda r: F.struct(r.target.alias("target"), r.cnt.alias("cnt"))
        )
        return counted.withColumn("links", pairs).drop("text")

    return scan_revisions(spark, path, project=narrow, name_regex=name_regex, after=min_ts)


def temporal_graph(
    spark: SparkSession,
    path: Paths,
    *,
    kind: str = "wikitext",
    count_in: str = "markup",
    min_ts: str | None = None,
    name_regex: str | None = None,
    include_open: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The temporal edges of a history dump.

    A revision without a valid time has no place in the history and is left out;
    ``revision_links`` shows it with its XML in ``corrupt``.
    """
    links = revision_links(
        spark, path, kind=kind, count_in=count_in, min_ts=min_ts, name_regex=name_regex
    )
    timed = links.filter(F.col("ts").isNotNull()).select("article", "rev_id", "ts", "links")
    return temporal_edges_from_arrays(timed, include_open=include_open, hot_rows=hot_rows)


def write_temporal_graph(
    spark: SparkSession,
    path: Paths,
    output: str,
    *,
    write: Callable[[DataFrame, str], None] = write_edges,
    **options,
) -> None:
    """``temporal_graph`` written to ``output``; staged tables are deleted then."""
    with staging_scope(spark):
        write(temporal_graph(spark, path, **options), output)


def page_link_table(
    spark: SparkSession, path: Paths, *, kind: str = "wikitext", count_in: str = "markup"
) -> DataFrame:
    """``(title, links)`` of a page dump, pages without links included."""
    pages = parse_pages_with_key(scan_pages(spark, path)).drop("file", "split", "pos")
    return page_links(pages, kind=kind, count_in=count_in)


def redirect_table(spark: SparkSession, path: Paths) -> DataFrame:
    """``(page_title, redirect_title)`` of a page dump."""
    return parse_redirects(parse_pages(scan_pages(spark, path)))


def flat_link_list(spark: SparkSession, path: Paths, *, kind: str = "wikitext") -> DataFrame:
    """``(page_title, target, cnt)``, one row per link occurrence of a page dump."""
    return flat_links(parse_pages(scan_pages(spark, path)), kind=kind)
