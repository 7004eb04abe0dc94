"""Scans of XML dumps, plain or compressed, split across tasks.

The text reader cuts a file at a tag of the wanted block instead of at line ends, so a split starts
and ends on a block boundary and each block is read once, whatever the split size. Codecs go by file
extension, bz2 files are split too.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.once import with_columns_once
from ..functions.text import unescape_xml, utc_time
from ..operators.pages import xml_options
from ..plans.staging import stage

# Fixed value: history files of a folder.
HISTORY_FILES = r"^history_revisions_\d+\.xml$"
# The tags of a page dump.
PAGE, PAGE_END = "<page>", "</page>"
REVISION, REVISION_END = "<revision>", "</revision>"
REDIRECT = "<redirect"
TITLE = r"<title>([^<]*)</title>"

REVISION_SCHEMA = "id STRING, timestamp STRING, text STRING, _corrupt_record STRING"
# Fixed value: extensions the text reader decompresses.
COMPRESSED = r"\.(bz2|gz|deflate|lz4|snappy|zst|xz)$"
# Fixed value: bytes of the mark that may stand at the start of a file. The reader takes it away.
MARK_BYTES = 3
# Rows of a split that are looked at together. A compressed file may be one split.
SPLIT_ROWS = 1 << 12
# Bytes of page heads that are sent to every task. Files with more are scanned in several lots.
HEAD_BYTES = 1 << 26
# A block may be one value up to this size.
BLOCK_BYTES = 1 << 30

Paths = str | Sequence[str]


def read_chunks(
    spark: SparkSession, path: Paths, tag: str, *, name_regex: str | None = None
) -> DataFrame:
    """Text between two occurrences of ``tag``: ``(file, file_size, split, pos, chunk)``.

    ``path`` may hold globs. ``name_regex`` selects files by name. ``pos`` orders the chunks of one
    split and ``split`` the splits of one file.
    """
    lines = spark.read.option("lineSep", tag).text(path if isinstance(path, str) else list(path))
    if name_regex is not None:
        lines = lines.filter(F.col("_metadata.file_name").rlike(name_regex))
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("chunk"),
    )


def scan_blocks(
    spark: SparkSession,
    path: Paths,
    start_tag: str,
    end_tag: str,
    *,
    name_regex: str | None = None,
    max_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Every block from start to end tag, tags included: ``(file, offset, block)``.

    ``offset`` is the byte position of the start tag, in the unpacked text where a file is compressed.
    A block goes from the first start tag after the block before to the next end tag, so a start tag may come
    again inside. What has no end tag, such as the last block of a file that was cut off, is no block; this
    is the same for plain, compressed and marked files. Only the byte order mark of a compressed file is not
    counted, as nothing tells of it. A block of more than ``max_bytes`` cannot be a value: it has its offset and
    a null text.

    Bytes before a split are only known once all splits are read, so the text is staged once. Positions are
    worked out on rows without text, and each text that is part of a block then travels once to its position.
    """
    chunks = stage(
        read_chunks(spark, path, start_tag, name_regex=name_regex)
        .withColumn("_bytes", F.octet_length("chunk").cast("long"))
        .withColumn("_ends", F.contains("chunk", F.lit(end_tag)))
        .withColumn("part", _part()),
        "chunks",
    )
    placed, closed = _with_places(chunks.drop("chunk"), len(start_tag.encode()))
    closed = F.broadcast(closed)  # a row per file, whose list the driver has anyway
    placed = stage(placed.join(closed, "file").filter(_IN_BLOCK), "places")
    rows = _texts_in_blocks(chunks, closed).join(
        placed.select("file", "pos", "_offset", "_run", "_alone"), ["file", "pos"]
    )
    inner = F.substring_index("chunk", end_tag, 1)
    alone = rows.filter("_alone").select("file", F.col("_offset").alias("offset"), inner.alias("inner"))
    # Start tags inside a block: their pieces are put together up to the end tag. Every run has one, and its size
    # is known before its texts are gathered.
    size = placed.filter("not _alone").groupBy("file", "_run").agg(F.sum("_bytes").alias("_size"))
    size = size.filter(F.col("_size") > max_bytes).select("file", "_run", F.lit(True).alias("_large"))
    pieces = rows.filter("not _alone").join(size, ["file", "_run"], "left")
    piece = F.struct("pos", "_offset", F.when(F.col("_large").isNull(), inner).alias("inner"))
    joined = (
        pieces.groupBy("file", "_run")
        .agg(F.sort_array(F.collect_list(piece)).alias("pieces"), F.first("_large").alias("_large"))
        .select(
            "file",
            F.element_at("pieces", 1)["_offset"].alias("offset"),
            F.when(
                F.col("_large").isNull(), F.array_join(F.transform("pieces", lambda p: p.inner), start_tag)
            ).alias("inner"),
        )
    )
    block = F.concat(F.lit(start_tag), "inner", F.lit(end_tag))
    return alone.unionByName(joined).select("file", "offset", block.alias("block"))


# Runs follow each other, so only what stands before the first start tag of a file or after its last end tag is in no
# block. That is one row per file, and a file without an end tag has none.
_IN_BLOCK = "_before > 0 and struct(split, pos) <= _closed"


def _texts_in_blocks(chunks: DataFrame, closed: DataFrame) -> DataFrame:
    """``(file, pos, chunk)`` of the chunks that may be in a block, told without moving any text."""
    return chunks.join(closed, "file").filter("struct(split, pos) <= _closed").select("file", "pos", "chunk")


def scan_pages(
    spark: SparkSession, path: Paths, *, name_regex: str | None = None
) -> DataFrame:
    """Page blocks of a dump with one revision per page: ``(file, split, pos, block)``.

    Pages do not nest, so the text is cut at the start tag: whether a page is whole can then be told
    from its own row, and one that the end of the file cuts off is left out, compressed or not.
    """
    chunks = read_chunks(spark, path, PAGE, name_regex=name_regex)
    inner = F.substring_index("chunk", PAGE_END, 1)
    return chunks.filter(F.contains("chunk", F.lit(PAGE_END))).select(
        "file", "split", "pos", F.concat(F.lit(PAGE), inner, F.lit(PAGE_END)).alias("block")
    )


def scan_pages_with_offset(
    spark: SparkSession, path: Paths, *, name_regex: str | None = None
) -> DataFrame:
    """Page blocks keyed by byte position: ``(file, offset, block)``; see ``scan_blocks``."""
    return scan_blocks(spark, path, PAGE, PAGE_END, name_regex=name_regex)


def scan_revisions(
    spark: SparkSession,
    path: Paths,
    *,
    project: Callable[[DataFrame], DataFrame] | None = None,
    name_regex: str | None = None,
    keep_redirects: bool = False,
    after: str | None = None,
    head_bytes: int = HEAD_BYTES,
) -> DataFrame:
    """Every revision of a history dump: ``(article, rev_id, ts, text, corrupt)``.

    A row is one revision, so a page of any length is read by many tasks. The title stands only at
    the start of the page, maybe splits away. So a first scan takes the heads of the pages, and a second one looks
    up the last head before each revision; its rows are neither shuffled nor sorted, and written once.
    Pages with a redirect tag ahead of their first revision are skipped before their text is parsed. ``ts`` is
    UTC wall-clock time. A malformed revision keeps its XML in ``corrupt`` and has null fields; one that the end of
    the file cuts off is left out. With ``after`` only revisions later than it are returned.

    ``project`` may replace ``text`` by something narrower, such as links. It runs in the scan
    task, before rows are written, and must keep all other columns. It sees neither revisions of redirect
    pages nor those that ``after`` leaves out.

    The result is a written table, so what is built on it does not scan again.
    """
    chunks = read_chunks(spark, path, REVISION, name_regex=name_regex).withColumn("part", _part())
    # What follows the revision may hold the head of the next page.
    chunks = chunks.withColumn("_tail", F.substring_index("chunk", REVISION_END, -1))

    def revisions(chunks: DataFrame, heads: DataFrame) -> DataFrame:
        found = revisions_of(chunks, heads, keep_redirects=keep_redirects, after=after)
        return project(found) if project else found

    with fixed_splits(spark, chunks):
        heads = stage(page_heads(chunks), "page-heads")
        # A row per file, whose list the driver has anyway.
        sizes = heads.groupBy("file").agg(F.sum("_head_bytes").alias("_bytes")).orderBy("file").collect()
        lots = _lots(sizes, head_bytes)
        if len(lots) <= 1:
            small = sum(r["_bytes"] for r in sizes) <= head_bytes
            return stage(revisions(chunks, F.broadcast(heads) if small else heads), "revisions")
        written = []
        for files, bytes_ in lots:
            some = heads.filter(F.col("file").isin(files))
            mine = chunks.filter(F.col("file").isin(files))
            written.append(stage(revisions(mine, F.broadcast(some) if bytes_ <= head_bytes else some), "revisions"))
        return reduce(DataFrame.unionByName, written)


def _lots(sizes: list, limit: int) -> list[tuple[list[str], int]]:
    """Files in lots of at most ``limit`` bytes of heads; a file with more is a lot of its own."""
    lots: list[tuple[list[str], int]] = []
    for file, size in sizes:
        if lots and lots[-1][1] + size <= limit:
            lots[-1] = ([*lots[-1][0], file], lots[-1][1] + size)
        else:
            lots.append(([file], size))
    return lots


@contextmanager
def fixed_splits(spark: SparkSession, scan: DataFrame) -> Iterator[None]:
    """Inside, every scan of a file is cut alike and a task reads one split, whatever else is read beside it.

    So ``pos`` counts the rows of its split, and two scans agree on it. For what is run inside, not for what is
    returned.
    """
    conf = spark._jsparkSession.sessionState().conf()
    files = scan._jdf.queryExecution().analyzed().collectLeaves().head()
    share = int(files.stats().sizeInBytes()) // max(spark.sparkContext.defaultParallelism, 1)
    split = max(1, min(conf.filesMaxPartitionBytes(), max(conf.filesOpenCostInBytes(), share)))
    # With so high a cost of opening a file, Spark neither makes splits smaller nor puts two into one task.
    wanted = {"maxPartitionBytes": split, "openCostInBytes": split, "minPartitionNum": None, "maxPartitionNum": None}
    names = [f"spark.sql.files.{n}" for n in wanted]
    before = {n: spark.conf.get(n, None) for n in names}
    _set(spark, dict(zip(names, wanted.values(), strict=True)))
    try:
        yield
    finally:
        _set(spark, before)


def _set(spark: SparkSession, values: dict) -> None:
    for name, value in values.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, str(value))


def page_heads(chunks: DataFrame) -> DataFrame:
    """Page heads of each part of a split: ``(file, split, part, heads, carried, _head_bytes)``.

    ``heads`` is sorted by ``pos``, the row whose tail holds the head; ``carried`` is the last head before the part.
    Each is ``STRUCT<pos, title, redirect>``.
    """
    own = F.substring_index("_tail", PAGE, -1)
    head = F.when(
        F.contains("_tail", F.lit(PAGE)),
        F.struct(
            "pos",
            unescape_xml(F.regexp_extract(own, TITLE, 1)).alias("title"),
            F.contains(own, F.lit(REDIRECT)).alias("redirect"),
        ),
    )
    rows = with_columns_once(chunks.select(*_PART, "pos", "_tail"), {"_head": head})
    parts = rows.groupBy(*_PART).agg(F.sort_array(F.collect_list("_head")).alias("heads"))
    along = _windows()[1]
    carried = F.last(F.try_element_at("heads", F.lit(-1)), True).over(along)
    size = F.aggregate(
        "heads", F.lit(64).cast("long"), lambda n, h: n + 32 + F.octet_length(h.title)
    )
    return parts.select("*", carried.alias("carried"), size.alias("_head_bytes"))


def revisions_of(
    chunks: DataFrame, heads: DataFrame, *, keep_redirects: bool = False, after: str | None = None
) -> DataFrame:
    """``(article, rev_id, ts, text, corrupt)`` of chunks, by the heads of their pages."""
    # Twelve halvings and one step find the place among the heads of a part.
    steps = SPLIT_ROWS.bit_length()
    middle = "(s.low + s.high) div 2"
    place = F.expr(
        f"aggregate(sequence(1, {steps}), named_struct('low', 0, 'high', size(heads)), (s, _) -> if("
        f"s.low >= s.high, s, if(heads[cast({middle} as int)].pos < pos, "
        f"named_struct('low', cast({middle} as int) + 1, 'high', s.high), "
        f"named_struct('low', s.low, 'high', cast({middle} as int)))), s -> s.low)"
    )
    page = F.coalesce(F.get("heads", place - 1), F.col("carried"))
    kept = F.contains("chunk", F.lit(REVISION_END)) & F.col("_page").isNotNull()
    if not keep_redirects:
        kept &= ~F.col("_page.redirect")
    texts = chunks.select(*_PART, "pos", "chunk").join(heads.drop("_head_bytes"), _PART)
    # The heads are no output of the look-up, so they are not copied to every row.
    texts = with_columns_once(texts, {"_page": page}).select("_page", "chunk").filter(kept)
    inner = F.substring_index("chunk", REVISION_END, 1)
    revision = F.from_xml(
        F.concat(F.lit(REVISION), inner, F.lit(REVISION_END)), REVISION_SCHEMA, xml_options("revision")
    )
    parsed = with_columns_once(texts.select("_page", "chunk"), {"_rev": revision}).select(
        F.col("_page.title").alias("article"),
        F.col("_rev.id").try_cast("long").alias("rev_id"),
        utc_time(F.col("_rev.timestamp")).alias("ts"),
        F.col("_rev.text").alias("text"),
        F.col("_rev._corrupt_record").alias("corrupt"),
    )
    if after is None:
        return parsed
    return parsed.filter(F.col("ts") > F.lit(after).cast("timestamp_ntz"))


# What precedes a chunk is put together in two steps: a window inside each part of a split, and one row
# per part, along its file, for what the parts before it add. Parts are bounded, also where a compressed
# file is a single split.
_PART = ["file", "split", "part"]


def _part() -> Column:
    """Number of the part of a split; the low 33 bits of ``pos`` count the rows of a task."""
    row = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    return F.floor(row / SPLIT_ROWS).cast("int")


def _windows():
    inside = Window.partitionBy(*_PART).orderBy("pos")
    along = Window.partitionBy("file").orderBy("split", "part")
    return tuple(w.rowsBetween(Window.unboundedPreceding, -1) for w in (inside, along))


def _with_places(chunks: DataFrame, tag_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Add the place of each chunk in its unpacked file; and per file the last chunk with an end tag, ``_closed``.

    ``_before`` counts the chunks before it, ``_offset`` the bytes before the tag it follows, ``_run`` the chunks
    before it that have an end tag. ``_alone`` says that no other chunk is in its run.
    """
    inside, along = _windows()
    one, ends = F.lit(1).cast("long"), F.col("_ends").cast("long")
    sums = {"_before": one, "_length": F.col("_bytes") + tag_bytes, "_run": ends}
    parts = chunks.groupBy(*_PART).agg(
        *[F.sum(v).alias(n) for n, v in sums.items()],
        F.max("file_size").alias("file_size"),
        F.max_by("_ends", "pos").alias("_last"),
        F.max(F.when(F.col("_ends"), F.struct("split", "pos"))).alias("_closed"),
    )
    parts = stage(parts, "parts")
    # Text and tags of a plain file are all its bytes, but for a mark at its start.
    whole = F.sum("_length").over(Window.partitionBy("file")) - tag_bytes
    marked = (F.col("file_size") - whole == MARK_BYTES) & ~F.col("file").rlike(COMPRESSED)
    carried = parts.select(
        *_PART,
        *[F.coalesce(F.sum(n).over(along), F.lit(0)).alias(f"{n}_carried") for n in sums],
        F.when(marked, MARK_BYTES).otherwise(0).alias("_mark"),
        F.last("_last").over(along).alias("_ended"),
    )
    placed = chunks.withColumns({n: F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in sums.items()}).join(
        carried, _PART
    )
    placed = placed.withColumns({n: F.col(n) + F.col(f"{n}_carried") for n in sums})
    near = Window.partitionBy(*_PART).orderBy("pos")
    # A chunk is alone if it ends and the one before it ends or stands at the start of the file. At the start of a
    # part that is told by the part before.
    previous = F.coalesce(F.lag("_ends").over(near), F.col("_ended"))
    closed = parts.groupBy("file").agg(F.max("_closed").alias("_closed")).filter("_closed is not null")
    placed = placed.withColumn("_offset", F.col("_length") - tag_bytes + F.col("_mark")).withColumn(
        "_alone", F.col("_ends") & ((F.col("_before") == 1) | F.coalesce(previous, F.lit(False)))
    )
    return placed, closed
