"""Pages and redirects from page blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.once import with_columns_once

# Title prefixes of page kinds, and how a redirect is written.
CATEGORY, FILE, TEMPLATE = "Category:", "File:", "Template:"
REDIRECT = r"(?i)^\s*#redirect\s*:?\s*\[\[([^\]|#]+)"

PAGE_SCHEMA = (
    "title STRING, id STRING, revision STRUCT<id: STRING, timestamp: STRING, text: STRING>, "
    "_corrupt_record STRING"
)


def xml_options(row_tag: str) -> dict[str, str]:
    """Options for ``from_xml`` that keep text as it is and malformed records in sight."""
    return {
        "rowTag": row_tag,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt_record",
        "ignoreSurroundingSpaces": "false",
        "nullValue": "\x00",
    }


def page_kinds(title: Column) -> dict[str, Column]:
    """Flags told from the title alone."""
    return {
        "is_category": title.startswith(CATEGORY),
        "is_file": title.startswith(FILE),
        "is_template": title.startswith(TEMPLATE),
    }


def parse_pages_with_key(blocks: DataFrame, *, block: str = "block") -> DataFrame:
    """Replace the page block by ``title, text, is_category, is_file, is_template``.

    All other columns stay. A page that is malformed or lacks text, id, revision id or timestamp
    is not dropped: it becomes a blank page, empty title and text, no flags.
    """
    keys = [c for c in blocks.columns if c != block]
    page = F.from_xml(F.col(block), PAGE_SCHEMA, xml_options("page"))
    fields = with_columns_once(blocks, {"_page": page}).select(
        *keys,
        F.col("_page.title").alias("_title"),
        F.col("_page.revision.text").alias("_text"),
        F.coalesce(
            F.col("_page._corrupt_record").isNull()
            & F.col("_page.revision.text").isNotNull()
            & F.col("_page.id").isNotNull()
            & F.col("_page.revision.id").isNotNull()
            & F.col("_page.revision.timestamp").isNotNull(),
            F.lit(False),
        ).alias("_whole"),
    )
    whole = F.col("_whole")
    title = F.when(whole, F.col("_title")).otherwise("")
    flags = {
        name: F.coalesce(whole & flag, F.lit(False))
        for name, flag in page_kinds(F.col("_title")).items()
    }
    return fields.select(
        *keys,
        title.alias("title"),
        F.when(whole, F.col("_text")).otherwise("").alias("text"),
        *[flag.alias(name) for name, flag in flags.items()],
    )


def parse_pages(blocks: DataFrame, *, block: str = "block") -> DataFrame:
    """``parse_pages_with_key`` without the key."""
    return parse_pages_with_key(blocks.select(block), block=block)


def articles(pages: DataFrame) -> DataFrame:
    """Pages with text that are no category, file or template."""
    return pages.filter(
        F.col("text").isNotNull()
        & ~F.col("is_category")
        & ~F.col("is_file")
        & ~F.col("is_template")
    )


def parse_redirects(pages: DataFrame) -> DataFrame:
    """``(page_title, redirect_title)`` of the articles that redirect."""
    target = F.trim(F.regexp_extract("text", REDIRECT, 1))
    return (
        articles(pages)
        .select(F.col("title").alias("page_title"), target.alias("redirect_title"))
        .filter(F.col("redirect_title") != "")
    )
