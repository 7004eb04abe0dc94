"""Writing revisions as an XML dump that the scans read back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import escape_xml, iso_seconds
from ..plans.sequence import HOT_ROWS, number_rows

# Revisions per <page> element; a longer history goes on in a further element of the same title.
PAGE_REVISIONS = 200


def revision_xml() -> Column:
    """``<revision>`` element of the columns ``rev_id, ts, text``."""
    return F.concat(
        F.lit("    <revision><id>"),
        F.col("rev_id").cast("string"),
        F.lit("</id><timestamp>"),
        iso_seconds("ts"),
        F.lit('Z</timestamp>\n      <text xml:space="preserve">'),
        escape_xml("text"),
        F.lit("</text></revision>\n"),
    )


def page_head(title: Column, page_id: Column, redirect: Column) -> Column:
    """Opening ``<page>`` tag with title, id and, where ``redirect`` is not null, a redirect tag."""
    tag = F.concat(F.lit('<redirect title="'), escape_xml(redirect), F.lit('" />'))
    return F.concat(
        F.lit("  <page>\n    <title>"),
        escape_xml(title),
        F.lit("</title><ns>0</ns><id>"),
        page_id.cast("string"),
        F.lit("</id>"),
        F.coalesce(tag, F.lit("")),
        F.lit("\n"),
    )


def history_pages(
    revisions: DataFrame, *, page_revisions: int = PAGE_REVISIONS, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``<page>`` elements of ``(article, page_id, redirect, rev_id, ts, text)`` as column ``value``."""
    numbered = number_rows(revisions, ["article"], ["ts", "rev_id"], hot_rows=hot_rows)
    part = F.floor((F.col("seq") - 1) / page_revisions).alias("part")
    body = F.sort_array(F.collect_list(F.struct("seq", revision_xml().alias("xml"))))
    pages = numbered.groupBy("article", part).agg(
        F.first("page_id").alias("page_id"),
        F.first("redirect").alias("redirect"),
        F.array_join(F.transform(body, lambda r: r.xml), "").alias("body"),
    )
    head = page_head(F.col("article"), F.col("page_id"), F.col("redirect"))
    return pages.select(F.concat(head, "body", F.lit("  </page>")).alias("value"))


def write_dump(pages: DataFrame, path: str, *, compression: str = "none") -> None:
    """Write ``<page>`` elements as text files."""
    pages.select("value").write.option("compression", compression).text(path)
