"""Properties of plans that matter at scale."""

import re

import pytest
from histories import frames, random_histories

from chronolink import queries
from chronolink.operators.edges import temporal_edges
from chronolink.operators.revisions import link_changes
from chronolink.operators.slicing import page_slice
from chronolink.sinks.write import numbered_pages

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_needed_columns(spark):
    text = plan(queries.temporal_edges(spark, SF_DIR))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == {
        "ts:timestamp_ntz,user_id:bigint,event_type:string",
        "ts:timestamp_ntz,user_id:bigint",
    }
    assert "PushedFilters: [IsNotNull(user_id)" in text


def test_links_are_shuffled_twice(spark, no_broadcast):
    revisions, links = frames(spark, random_histories(1, articles=5))
    text = plan(temporal_edges(revisions, links))
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", text)
    keys = sorted(re.sub(r"#\d+L?", "", k) for k in keys)
    # Once to meet its revision (with the revisions, ordered by article) and once to form runs.
    assert keys == ["article", "article, rev_id", "article, rev_id", "article, target, cnt"]


def test_hot_articles_have_no_window_of_their_own_size(spark, no_broadcast):
    revisions, links = frames(spark, random_histories(1, articles=5))
    text = plan(temporal_edges(revisions, links, hot_rows=5))
    specs = re.findall(r"\], \[([a-z_, #\dL]*)\], \[[^\]]*\]\n", re.sub(r"#\d+L?", "", text))
    # The only window over whole articles is that of the articles known to be small (anti join), and
    # that over the sizes of ranges.
    assert [s for s in specs if s == "article"] and "LeftAnti" in text
    others = {s for s in specs if s != "article"}
    assert others == {
        "_range, article",
        "article, target, cnt",
        "article, target, cnt, _slice",
        "article, target, cnt, _lane",
    }


def test_cold_articles_meet_no_slices(spark, no_broadcast):
    revisions, links = frames(spark, random_histories(1, articles=5))
    union = temporal_edges(revisions, links, hot_rows=5)._jdf.queryExecution().optimizedPlan()
    assert union.nodeName() == "Union"
    cold, hot = (union.children().apply(n).toString() for n in (0, 1))
    assert "_slice" not in cold and "_lane" not in cold and "LeftAnti" in cold
    assert "_slice" in hot and "_lane" in hot


def test_changes_have_no_window_over_links(spark, no_broadcast):
    revisions, links = frames(spark, random_histories(1, articles=5))
    text = plan(link_changes(revisions, links))
    assert text.count("Window [") == 1  # the order of revisions


def test_numbering_a_table_does_not_shuffle_it_again(spark):
    pages = spark.range(100).selectExpr("id as page_id", "'t' as title", "'b' as block")
    text = plan(numbered_pages(pages, ["page_id"]))
    assert "Window" not in text and "Exchange hashpartitioning" not in text


@pytest.mark.parametrize(
    "name", ["links_flat", "links_strict", "link_total_counts", "page_parse", "page_redirects"]
)
def test_work_inside_the_row_does_not_shuffle(spark, name):
    assert "Exchange" not in plan(queries.QUERIES[name](spark, SF_DIR))


def test_a_slice_reads_only_its_ranges(spark, monkeypatch):
    monkeypatch.setattr("chronolink.operators.slicing.TOP_K_ROWS", 10)
    pages = spark.range(20_000).selectExpr("20000 - id as page_id", "repeat('x', 50) as block")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with tables of a size that matters
    try:
        part = page_slice(pages, ["page_id"], skip=9000, take=300)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(r.page_id for r in part.collect()) == list(range(9001, 9301))
    scan = part._jdf.queryExecution().executedPlan().collectLeaves().head()
    read = scan.metrics().get("numOutputRows").get().value()
    assert 300 <= read <= 12_000  # two of the four ranges at most
    assert "PushedFilters: [IsNotNull(_id), GreaterThanOrEqual(_id" in plan(part)
