"""The operators bound to the test tables: one query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import edge_line, file_key, unescape_html
from .operators import edges as E
from .operators import links as L
from .operators import pages as P
from .operators import revisions as R
from .operators.slicing import page_slice as slice_pages
from .plans import jobs
from .plans.staging import new_path
from .sinks.render import history_pages, page_head, revision_xml, write_dump
from .sinks.write import article_manifest, split_pages, write_edges
from .sources import dump

EPOCH = "2020-01-01 00:00:00"
# So few rows make an article hot in the queries of the hot branch.
HOT = 5


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Histories from events: a user is an article, a day with events is a revision, an event type is a
# target and its number of events that day the count.


def event_links(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return (
        _table(spark, sf_dir, "events")
        .select(F.col("user_id").alias("article"), day.alias("rev_id"), F.col("event_type").alias("target"))
        .groupBy("article", "rev_id", "target")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def event_revisions(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return (
        _table(spark, sf_dir, "events")
        .select(F.col("user_id").alias("article"), day.alias("rev_id"))
        .distinct()
        .withColumn("ts", F.col("rev_id"))
    )


def temporal_edges(spark, sf_dir):
    return E.temporal_edges(event_revisions(spark, sf_dir), event_links(spark, sf_dir))


def temporal_edges_open(spark, sf_dir):
    revisions, links = event_revisions(spark, sf_dir), event_links(spark, sf_dir)
    return E.temporal_edges(revisions, links, include_open=True)


def temporal_edges_arrays(spark, sf_dir):
    rev_links = (
        event_links(spark, sf_dir)
        .groupBy("article", "rev_id")
        .agg(F.collect_list(F.struct("target", "cnt")).alias("links"))
        .withColumn("ts", F.col("rev_id"))
    )
    return E.temporal_edges_from_arrays(rev_links)


def temporal_edges_orders(spark, sf_dir):
    orders, lineitem, part = (_table(spark, sf_dir, n) for n in ("orders", "lineitem", "part"))
    revisions = orders.select(
        F.col("o_custkey").alias("article"),
        F.col("o_orderkey").alias("rev_id"),
        F.col("o_orderdate").alias("ts"),
    )
    links = (
        lineitem.select("l_orderkey", "l_partkey")
        .join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("rev_id"), F.col("p_brand").alias("target"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .join(revisions.select("article", "rev_id"), "rev_id")
    )
    return E.temporal_edges(revisions, links)


def edge_lines(spark, sf_dir):
    return temporal_edges(spark, sf_dir).select("article", edge_line().alias("line"))


def revision_order(spark, sf_dir):
    ordered = R.order_revisions(event_revisions(spark, sf_dir))
    return ordered.select("article", "ts", "seq", "next_ts")


def revisions_grouped(spark, sf_dir):
    return R.group_revisions(event_revisions(spark, sf_dir))


def temporal_edges_hot(spark, sf_dir):
    """Every article cut into ranges and slices."""
    revisions, links = event_revisions(spark, sf_dir), event_links(spark, sf_dir)
    return E.temporal_edges(revisions, links, hot_rows=HOT)


def article_history(spark, sf_dir, **options):
    rev_links = (
        event_links(spark, sf_dir)
        .groupBy("article", "rev_id")
        .agg(F.sort_array(F.collect_list(F.struct("target", "cnt"))).alias("links"))
        .withColumn("ts", F.col("rev_id"))
    )
    parts = R.article_history(rev_links, part_size=10, **options)
    revisions = parts.select(
        "article", "part", "first_pos", "last_pos", F.posexplode("revisions").alias("at", "revision")
    )
    return revisions.select(
        "article",
        "part",
        "first_pos",
        "last_pos",
        (F.col("first_pos") + F.col("at")).alias("pos"),
        F.col("revision.ts").alias("ts"),
        F.posexplode("revision.links").alias("link_at", "link"),
    ).select("article", "part", "first_pos", "last_pos", "pos", "ts", "link_at", "link.*")


def article_history_hot(spark, sf_dir):
    return article_history(spark, sf_dir, hot_rows=HOT)


def _event_changes(spark, sf_dir, **options):
    return R.link_changes(event_revisions(spark, sf_dir), event_links(spark, sf_dir), **options)


def link_changes_hot(spark, sf_dir):
    return _event_changes(spark, sf_dir, hot_rows=HOT).drop("rev_id")


def delta_kept(spark, sf_dir):
    return R.kept(_event_changes(spark, sf_dir)).drop("rev_id")


def delta_removed(spark, sf_dir):
    return R.removed(_event_changes(spark, sf_dir)).drop("rev_id")


def delta_added(spark, sf_dir):
    return R.added(_event_changes(spark, sf_dir)).drop("rev_id")


def delta_merged(spark, sf_dir):
    return R.merged(_event_changes(spark, sf_dir)).drop("rev_id")


def link_delta(spark, sf_dir):
    sets = R.link_delta(event_revisions(spark, sf_dir), event_links(spark, sf_dir))
    # One row per array and element; an empty array keeps a row, so that no revision can be lost.
    names = ("kept", "removed", "added", "merged")
    arrays = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("links")) for n in names])
    each = sets.select("article", "ts", F.explode(arrays).alias("set"))
    return each.select(
        "article", "ts", F.col("set.name").alias("name"), F.posexplode_outer("set.links").alias("at", "link")
    ).select("article", "ts", "name", "at", "link.target", "link.cnt")


def distinct_links(spark, sf_dir):
    return E.distinct_links(event_revisions(spark, sf_dir), event_links(spark, sf_dir))


def min_ts_filter(spark, sf_dir):
    revisions = event_revisions(spark, sf_dir).select("article", "ts")
    return R.after(revisions, "2024-01-10 00:00:00")


def edge_sink_roundtrip(spark, sf_dir):
    path = new_path(spark, "edges")
    write_edges(temporal_edges(spark, sf_dir), path, buckets=16)
    return spark.read.parquet(path).drop("bucket")


def edge_article_sink(spark, sf_dir):
    path = new_path(spark, "article-edges")
    write_edges(temporal_edges(spark, sf_dir), path, layout="article", format="text", buckets=16)
    return spark.read.text(path).select("value")


def edge_article_manifest(spark, sf_dir):
    """Rows of each article, as the manifest of the written edges has them."""
    path = new_path(spark, "article-edges")
    write_edges(temporal_edges(spark, sf_dir), path, layout="article", buckets=16)
    places = article_manifest(spark, path)
    return places.groupBy("file_key", "article").agg(F.sum("n_rows").alias("n_rows"))


def edge_text_sink(spark, sf_dir):
    path = new_path(spark, "edge-lines")
    write_edges(temporal_edges(spark, sf_dir), path, format="text", buckets=16)
    return spark.read.text(path).select("value")


# Pages: the HTML is the text, its <title> the title.


def html_pages(spark, sf_dir):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return _table(spark, sf_dir, "pages").select(
        "page_id", title.alias("title"), F.col("html").alias("text")
    )


def links_flat(spark, sf_dir):
    return L.flat_links(html_pages(spark, sf_dir), kind="text")


def links_strict(spark, sf_dir):
    prefix = F.element_at(
        F.array(*[F.lit(p) for p in ("", "User:", "Talk:", "/")]),
        (F.col("page_id") % 4 + 1).cast("int"),
    )
    prefixed = F.regexp_replace(F.col("text"), F.lit("(<a [^>]*>)"), F.concat(F.lit("$1"), prefix))
    pages = html_pages(spark, sf_dir).withColumn("text", prefixed)
    strict = L.with_strict_links(pages, kind="text")
    return strict.select("page_id", F.explode("targets").alias("target"))


def _counted_pages(spark, sf_dir):
    counted = L.with_link_counts(html_pages(spark, sf_dir), kind="text")
    return counted.select("page_id", F.inline("links"))


def link_anchor_counts(spark, sf_dir):
    counted = L.with_anchor_counts(html_pages(spark, sf_dir), kind="text")
    return counted.select("page_id", F.inline("links")).select(
        "page_id", "target", F.col("anchors").alias("cnt")
    )


def link_mention_counts(spark, sf_dir):
    return _counted_pages(spark, sf_dir).select("page_id", "target", "mentions")


def link_mention_counts_text(spark, sf_dir):
    counted = L.with_link_counts(html_pages(spark, sf_dir), kind="text", count_in="text")
    return counted.select("page_id", F.inline("links")).select("page_id", "target", "mentions")


def link_total_counts(spark, sf_dir):
    return _counted_pages(spark, sf_dir).select("page_id", "target", "cnt")


def page_links_grouped(spark, sf_dir):
    # Every tenth page has no text, so its row must stay with no links.
    text = F.when(F.col("page_id") % 10 != 9, F.col("text"))
    return _link_rows(L.page_links(html_pages(spark, sf_dir).withColumn("text", text), kind="text"))


def _link_rows(grouped: DataFrame) -> DataFrame:
    """One row per target with its position; a page without links keeps a row."""
    rows = grouped.select("title", F.posexplode_outer("links").alias("at", "link"))
    return rows.select("title", "at", "link.target", "link.cnt")


# Anchors as they are found in the wild: the title in an attribute, either quotes, any case, labels with
# markup, outside links.


def _titled_pages(spark, sf_dir):
    pages = html_pages(spark, sf_dir)
    wild = F.element_at(
        F.array(
            F.lit('<a href="$1" title="$2">$2</a>'),
            F.lit("<A HREF='$1' Title='$2'><b>$2</b> <i>more</i></A>"),
            F.lit('<a\nclass="external free" href="$1" title="$2">$2</a>'),
            F.lit('<a title = "Talk:$2" href="$1">$2</a>'),
            F.lit("<a href='$1'>no title</a>"),
        ),
        (F.col("page_id") % 5 + 1).cast("int"),
    )
    plain = F.lit('<a href="([^"]*)">([^<]*)</a>')
    return pages.withColumn("text", F.regexp_replace("text", plain, wild))


def links_title(spark, sf_dir):
    return L.flat_links(_titled_pages(spark, sf_dir), kind="title")


def link_title_counts(spark, sf_dir):
    counted = L.with_link_counts(_titled_pages(spark, sf_dir), kind="title")
    return counted.select("page_id", F.inline("links"))


def link_html_counts(spark, sf_dir):
    """Anchors without quotes, with a tag's end inside quotes, in comments, scripts and style sheets."""
    html = F.element_at(
        F.array(
            F.lit("<a href=$1 title=$2>z</a>"),
            F.lit('<a title="$2>x" href="$1"><i>z</i></a>'),
            F.lit('<!-- <a href="$1" title="$2">z</a> -->'),
            F.lit('<script>show(\'<a href="$1" title="$2">z</a>\')</script>'),
            F.lit("<a data-title='title=\"no\"' href=$1 class=\"a>b external\" title='$2'>z</a>"),
            F.lit('<style>/* <a title="$2">z</a> */</style><A TITLE=\'$2\'>$2</A>'),
        ),
        (F.col("page_id") % 6 + 1).cast("int"),
    )
    wild = F.regexp_replace("text", F.lit('<a href="([^"]*)">([^<]*)</a>'), html)
    pages = html_pages(spark, sf_dir).withColumn("text", wild)
    return L.with_link_counts(pages, kind="title").select("page_id", F.inline("links"))


def wikitext_hidden(spark, sf_dir):
    """Links beside comments, inside ``nowiki`` and without an end."""
    role = F.col("role")
    text = F.concat(
        F.lit("[["), role, F.lit("]] <!-- [["), role, F.lit("]] "), role, F.lit(" --> <nowiki>[["), role,
        F.lit("]]</nowiki> [[file:x.png|thumb]] [[Open and "), role,
    )
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("text"))
    return L.with_link_counts(turns).select("conv_id", "turn", F.inline("links"))


def title_entities(spark, sf_dir):
    return html_pages(spark, sf_dir).select("page_id", unescape_html("title").alias("title"))


def file_keys(spark, sf_dir):
    return html_pages(spark, sf_dir).select("page_id", file_key("title").alias("file_key"))


def page_slice(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return slice_pages(pages, ["page_id"], skip=10, take=20)


def _page_blocks(spark, sf_dir, *, odd: bool = False):
    """Pages as <page> blocks with titles of four kinds; ``odd``: with redirects, and every tenth without text."""
    kind = F.element_at(
        F.array(*[F.lit(p) for p in ("", "Category:", "File:", "Template:")]),
        (F.col("page_id") % 4 + 1).cast("int"),
    )
    redirect = F.concat(F.lit("#REDIRECT [["), F.col("title"), F.lit("]]"))
    rows = html_pages(spark, sf_dir).select(
        "page_id",
        F.concat(kind, F.col("title")).alias("title"),
        F.when((F.col("page_id") % 5 == 0) & F.lit(odd), redirect).otherwise(F.col("text")).alias("text"),
        F.col("page_id").alias("rev_id"),
        F.lit(EPOCH).cast("timestamp_ntz").alias("ts"),
    )
    head = page_head(F.col("title"), F.col("page_id"), F.lit(None).cast("string"))
    whole = F.concat(head, revision_xml(), F.lit("  </page>"))
    block = F.when((F.col("page_id") % 10 != 9) | ~F.lit(odd), whole).otherwise(F.concat(head, F.lit("  </page>")))
    return rows.select("page_id", block.alias("block"))


def page_parse(spark, sf_dir):
    pages = P.parse_pages_with_key(_page_blocks(spark, sf_dir, odd=True))
    return pages.select(
        "page_id",
        "title",
        F.md5("text").alias("text_md5"),
        "is_category",
        "is_file",
        "is_template",
    )


def page_redirects(spark, sf_dir):
    return P.parse_redirects(P.parse_pages(_page_blocks(spark, sf_dir, odd=True)))


def page_split(spark, sf_dir):
    titled = html_pages(spark, sf_dir).withColumnRenamed("text", "block")
    path = new_path(spark, "split")
    split_pages(titled, path, ["page_id"], pages_per_bucket=100)
    written = spark.read.parquet(path)
    return written.select("n", "page_file", F.md5("block").alias("block_md5"))


# Dumps: tables written as XML files and scanned back.


# Pages of one file of the dump of list items.
FILE_PAGES = 100


def tag_blocks(spark, sf_dir):
    """List items of pages written as files of fixed id ranges, so that offsets can be told in SQL, too."""
    path = new_path(spark, "html")
    part = F.floor(F.col("page_id") / FILE_PAGES)
    rows = _table(spark, sf_dir, "pages").select(
        "page_id", part.alias("part"), F.regexp_replace("html", "\n", " ").alias("value")
    )
    sorted_rows = rows.repartition("part").sortWithinPartitions("part", "page_id")
    sorted_rows.select("part", "value").write.partitionBy("part").text(path)
    file_part = F.regexp_extract("file", "part=([0-9]+)", 1).cast("long")
    return dump.scan_blocks(spark, path, "<li>", "</li>").select(file_part.alias("part"), "block", "offset")


def _page_dump(spark, sf_dir, **options):
    path = new_path(spark, "pages")
    write_dump(_page_blocks(spark, sf_dir, **options).withColumnRenamed("block", "value"), path)
    return path


def dump_pages(spark, sf_dir):
    blocks = dump.scan_pages_with_offset(spark, _page_dump(spark, sf_dir))
    pages = P.parse_pages_with_key(blocks)
    return pages.select(
        "title", F.md5("text").alias("text_md5"), "is_category", "is_file", "is_template"
    )


def page_link_extract(spark, sf_dir):
    return _link_rows(jobs.page_link_table(spark, _page_dump(spark, sf_dir), kind="text"))


def redirect_table(spark, sf_dir):
    return jobs.redirect_table(spark, _page_dump(spark, sf_dir, odd=True))


def flat_link_list(spark, sf_dir):
    return jobs.flat_link_list(spark, _page_dump(spark, sf_dir), kind="text")


def conversation_revisions(spark, sf_dir):
    """A conversation is an article, a turn a revision that links its first word and its role.

    Every seventh conversation is a redirect page.
    """
    word = F.regexp_extract("text", r"^[^\s\[\]|#]+", 0)
    return _table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("R&D "), F.col("conv_id").cast("string")).alias("article"),
        F.col("conv_id").alias("page_id"),
        F.when(F.col("conv_id") % 7 == 0, F.lit("Main")).alias("redirect"),
        F.col("turn").alias("rev_id"),
        (
            F.lit(EPOCH).cast("timestamp_ntz")
            + F.make_dt_interval(mins=F.col("turn").cast("int"))
        ).alias("ts"),
        F.concat(
            F.lit("[["), word, F.lit("]] [["), F.col("role"), F.lit("|by]] [[User:"),
            F.col("role"), F.lit("]] "), F.col("text"),
        ).alias("text"),
    )


def _history_dump(spark, sf_dir):
    """Two folders: even conversations compressed, odd ones plain. Returns a glob for both."""
    path = new_path(spark, "history")
    revisions = conversation_revisions(spark, sf_dir)
    for part, compression in ((0, "bzip2"), (1, "none")):
        pages = history_pages(revisions.filter(F.col("page_id") % 2 == part))
        write_dump(pages, f"{path}/part{part}", compression=compression)
    return f"{path}/part*"


def dump_revisions(spark, sf_dir):
    path = _history_dump(spark, sf_dir)
    revisions = dump.scan_revisions(spark, path, name_regex=r"^part-.*\.(bz2|txt)$")
    return revisions.select("article", "rev_id", "ts", F.md5("text").alias("text_md5"))


def wikitext_links(spark, sf_dir):
    titled = conversation_revisions(spark, sf_dir).withColumnRenamed("article", "title")
    return L.flat_links(titled)


def evolving_graph(spark, sf_dir):
    return jobs.temporal_graph(spark, _history_dump(spark, sf_dir))


def evolving_graph_cutoff(spark, sf_dir):
    return jobs.temporal_graph(spark, _history_dump(spark, sf_dir), min_ts="2020-01-01 00:01:00")


QUERIES = {
    f.__name__: f
    for f in (
        temporal_edges,
        temporal_edges_open,
        temporal_edges_hot,
        temporal_edges_arrays,
        temporal_edges_orders,
        edge_lines,
        revision_order,
        revisions_grouped,
        article_history,
        article_history_hot,
        delta_kept,
        delta_removed,
        delta_added,
        delta_merged,
        link_changes_hot,
        link_delta,
        distinct_links,
        min_ts_filter,
        edge_sink_roundtrip,
        edge_text_sink,
        edge_article_sink,
        edge_article_manifest,
        links_flat,
        links_strict,
        link_anchor_counts,
        link_mention_counts,
        link_mention_counts_text,
        link_total_counts,
        page_links_grouped,
        links_title,
        link_title_counts,
        link_html_counts,
        wikitext_hidden,
        title_entities,
        file_keys,
        page_slice,
        page_parse,
        page_redirects,
        page_split,
        tag_blocks,
        dump_pages,
        dump_revisions,
        wikitext_links,
        evolving_graph,
        evolving_graph_cutoff,
        page_link_extract,
        redirect_table,
        flat_link_list,
    )
}
