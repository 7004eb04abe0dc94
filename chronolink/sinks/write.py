"""Writers. Output is split by a hash or range of the key, not one file per article or page."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import edge_line, file_key
from ..plans.sequence import number_rows

BUCKETS = 64
# Fixed value: page files are named after their number and title.
PAGES_PER_BUCKET = 10_000


def bucketed_edges(edges: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Edges with their ``bucket``, gathered by it and sorted for writing.

    The rebalance hint lets adaptive execution split a bucket that a hot article makes too large
    and join buckets that are small; every piece is sorted by article and time.
    """
    bucket = F.pmod(F.xxhash64("article"), F.lit(buckets)).cast("int")
    return (
        edges.withColumn("bucket", bucket)
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "article", "valid_to", "target", "cnt")
    )


def write_edges(
    edges: DataFrame,
    path: str,
    *,
    layout: str = "bucket",
    format: str = "parquet",
    buckets: int = BUCKETS,
    mode: str = "errorifexists",
) -> None:
    """Write edges into ``buckets`` folders.

    ``layout="bucket"`` hashes articles into the folders. ``layout="article"`` hashes file keys (the title without
    whitespace), keeps the rows of an article together in each file, and writes a manifest beside the folders that says
    which rows of which files are an article's; see ``article_manifest`` and ``read_article``. Articles that differ in
    whitespace only share a file key, but not their rows. ``format="parquet"`` keeps columns, ``"text"`` writes
    ``[from,to] target count`` lines with the article and a tab in front, in either layout.
    """
    if layout not in ("bucket", "article"):
        raise ValueError(f"layout must be 'bucket' or 'article', not {layout!r}")
    line = F.concat(F.col("article").cast("string"), F.lit("\t"), edge_line())
    rows = bucketed_edges(edges, buckets) if layout == "bucket" else _keyed_edges(edges, buckets)
    if format == "text":
        rows = rows.select("bucket", line.alias("value"))
    rows.write.mode(mode).partitionBy("bucket").format(format).save(path)
    if layout == "article":
        _write_manifest(edges.sparkSession, path, format, edges.schema["article"].dataType.simpleString())


def _key_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _keyed_edges(edges: DataFrame, buckets: int) -> DataFrame:
    key = file_key(F.col("article").cast("string"))
    return (
        edges.withColumn("file_key", key)
        .withColumn("bucket", _key_bucket(F.col("file_key"), buckets))
        .hint("rebalance", "bucket")
        .sortWithinPartitions("bucket", "file_key", "article", "valid_to", "target", "cnt")
    )


# A leading underscore keeps a folder out of what Spark reads under the path.
MANIFEST = "_manifest"


def _write_manifest(spark: SparkSession, path: str, format: str, article_type: str) -> None:
    """Write ``(file_key, article, file, first_row, n_rows)``, sorted by file key so that a look-up reads little of it.

    Rows are counted per article and file; as files are sorted, what precedes in the file gives the first row. Nothing
    of the size of the edges is shuffled.
    """
    written = spark.read.format(format).load(path)
    article = F.substring_index("value", "\t", 1).cast(article_type) if format == "text" else F.col("article")
    counts = (
        written.select(article.alias("article"), F.col("_metadata.file_path").alias("file"))
        .groupBy("file", "article")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("file_key", file_key(F.col("article").cast("string")))
    )
    before = Window.partitionBy("file").orderBy("file_key", "article").rowsBetween(Window.unboundedPreceding, -1)
    manifest = counts.withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0)))
    (
        manifest.select("file_key", "article", "file", "first_row", "n_rows")
        .repartitionByRange("file_key", "article")
        .sortWithinPartitions("file_key", "article", "first_row")
        .write.mode("overwrite")
        .parquet(f"{path}/{MANIFEST}")
    )


def article_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Where the rows of each article are: ``(file_key, article, file, first_row, n_rows)``.

    ``path`` was written with ``layout="article"``. Rows count from 0 in the file. An article has a row per file, and more
    than one file only if it is so large that its bucket was split.
    """
    return spark.read.parquet(f"{path}/{MANIFEST}")


def read_article(spark: SparkSession, path: str, key: str, *, format: str = "parquet") -> DataFrame:
    """The edges (or lines) of the articles of one file key, from the files that hold them and no others."""
    key = re.sub(r"[ \t\n\x0B\f\r]", "", key)
    wanted = article_manifest(spark, path).filter(F.col("file_key") == key)
    files = [r["file"] for r in wanted.select("file").distinct().collect()]  # pieces of one bucket
    written = spark.read.format(format).load(path)
    rows = written.filter(F.col("_metadata.file_path").isin(files)) if files else written.limit(0)
    if format == "text":
        return rows.filter(file_key(F.substring_index("value", "\t", 1)) == key).select("value")
    return rows.filter(F.col("file_key") == key).drop("file_key", "bucket")


def numbered_pages(pages: DataFrame, order: list[str]) -> DataFrame:
    """Add ``n``, the position in ``order`` from 0, and ``page_file``, ``{n}-{title}.xml``."""
    name = F.concat(F.col("n").cast("string"), F.lit("-"), F.col("title"), F.lit(".xml"))
    return (
        number_rows(pages, [], order)
        .withColumn("n", F.col("seq") - 1)
        .withColumn("page_file", name)
        .drop("seq")
    )


def split_pages(
    pages: DataFrame,
    path: str,
    order: list[str],
    *,
    layout: str = "bucket",
    pages_per_bucket: int = PAGES_PER_BUCKET,
    mode: str = "errorifexists",
) -> None:
    """Write the ``block`` of each page under its own name.

    ``layout="bucket"`` writes a table of ``page_file, block`` in folders of consecutive pages.
    ``layout="page"`` makes one folder per page file, for a limited number of pages.
    """
    rows = numbered_pages(pages, order)
    if layout == "bucket":
        bucket = F.floor(F.col("n") / pages_per_bucket)
        rows = rows.select(bucket.alias("bucket"), "n", "page_file", "block")
        rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "n").write.mode(
            mode
        ).partitionBy("bucket").parquet(path)
    elif layout == "page":
        rows.select("page_file", F.col("block").alias("value")).write.mode(mode).partitionBy(
            "page_file"
        ).text(path)
    else:
        raise ValueError(f"layout must be 'bucket' or 'page', not {layout!r}")
