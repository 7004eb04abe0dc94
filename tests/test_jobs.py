import pytest
from histories import at, random_histories, result, walk_edges

from chronolink.plans import jobs, staging
from chronolink.sinks.render import history_pages, page_head, revision_xml, write_dump
from pyspark.sql import functions as F


def wikitext(links):
    # A count of two is one link and one mention.
    return " ".join(f"[[T{t}|label]]" + (f" T{t}" if n == 2 else "") for t, n in links.items())


@pytest.fixture(scope="module")
def history(spark, tmp_path_factory):
    histories = {f"{a} & co": revs for a, revs in random_histories(21, articles=25).items()}
    rows = [
        (a, n, "Main" if n % 6 == 5 else None, r, t, wikitext(links))
        for n, (a, revs) in enumerate(histories.items())
        for r, t, links in revs
    ]
    schema = "article string, page_id long, redirect string, rev_id long, ts timestamp_ntz, text string"
    path = str(tmp_path_factory.mktemp("dump") / "h")
    pages = history_pages(spark.createDataFrame(rows, schema), page_revisions=7)
    write_dump(pages, path, compression="bzip2")
    kept = {a: revs for n, (a, revs) in enumerate(histories.items()) if n % 6 != 5}
    kept = {
        a: [(r, t, {f"T{k}": c for k, c in links.items()}) for r, t, links in revs]
        for a, revs in kept.items()
    }
    return path, kept


@pytest.mark.parametrize("hot_rows", [4, 100_000])
@pytest.mark.parametrize("include_open", [False, True])
def test_temporal_graph(spark, history, small_splits, include_open, hot_rows):
    path, kept = history
    edges = jobs.temporal_graph(spark, path, include_open=include_open, hot_rows=hot_rows)
    assert result(edges) == walk_edges(kept, include_open)


def test_cutoff(spark, history):
    path, kept = history
    later = {a: [r for r in revs if r[1] > at(10)] for a, revs in kept.items()}
    edges = jobs.temporal_graph(spark, path, min_ts=str(at(10)))
    assert result(edges) == walk_edges(later)


def test_written_graph(spark, history, tmp_path):
    path, kept = history
    output = str(tmp_path / "edges")
    jobs.write_temporal_graph(spark, path, output)
    back = spark.read.parquet(output).drop("bucket")
    assert result(back) == walk_edges(kept)


@pytest.fixture(scope="module")
def page_dump(spark, tmp_path_factory):
    rows = [
        (1, "A", "[[B]] [[B|b]] [[User:U]] B"),
        (2, "B", "#REDIRECT [[A]]"),
        (3, "Category:C", "#REDIRECT [[A]]"),
        (4, "D & E", "nothing"),
    ]
    df = spark.createDataFrame(rows, "rev_id long, title string, text string").withColumn(
        "ts", F.lit("2020-01-01 00:00:00").cast("timestamp_ntz")
    )
    head = page_head(F.col("title"), F.col("rev_id"), F.lit(None).cast("string"))
    path = str(tmp_path_factory.mktemp("pages") / "p")
    write_dump(df.select(F.concat(head, revision_xml(), F.lit("  </page>")).alias("value")), path)
    return path


def test_page_jobs(spark, page_dump):
    table = {r.title: [tuple(x) for x in r.links] for r in jobs.page_link_table(spark, page_dump).collect()}
    assert table == {"A": [("B", 3)], "B": [("A", 1)], "Category:C": [("A", 1)], "D & E": []}
    assert result(jobs.redirect_table(spark, page_dump)) == [("B", "A")]
    assert result(jobs.flat_link_list(spark, page_dump)) == [
        ("A", "B", 1), ("A", "B", 1), ("B", "A", 1), ("Category:C", "A", 1),
    ]


def test_staging_folder(spark):
    assert staging.staging_root(spark) == spark.conf.get("spark.checkpoint.dir")

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    with pytest.raises(RuntimeError):
        staging.staging_root(Session(**{"spark.master": "yarn"}))
    assert staging.staging_root(Session(**{"spark.master": "local[2]"}))


def test_written_job_leaves_nothing_staged(spark, tmp_path, monkeypatch):
    from chronolink.plans import jobs, staging

    monkeypatch.setattr(staging, "staging_root", lambda _: str(tmp_path / "staged"))
    (tmp_path / "h.xml").write_text(
        "<page><title>A</title>"
        + "".join(
            f"<revision><id>{k}</id><timestamp>2020-01-0{k}T00:00:00Z</timestamp><text>{'[[B]]' * (k == 1)}</text></revision>\n"
            for k in (1, 2)
        )
        + "</page>\n"
    )
    jobs.write_temporal_graph(spark, str(tmp_path / "h.xml"), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    assert list((tmp_path / "staged").iterdir()) == []
