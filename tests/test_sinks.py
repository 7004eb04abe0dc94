from pathlib import Path
from urllib.parse import unquote

import pytest
from histories import at, frames, random_histories, result
from pyspark.sql import functions as F

from chronolink.operators.edges import temporal_edges
from chronolink.operators.slicing import page_slice
from chronolink.sinks import write as W


@pytest.fixture(scope="module")
def edges(spark):
    histories = random_histories(11)
    histories["A B/Ü"] = [(9001, at(1), {"X Y": 1}), (9002, at(2), {})]
    df = temporal_edges(*frames(spark, histories)).persist()
    yield df
    df.unpersist()


def test_buckets_hold_every_edge_in_order(spark, edges, tmp_path):
    path = str(tmp_path / "out")
    W.write_edges(edges, path, buckets=4)
    back = spark.read.parquet(path)
    assert result(back.select(edges.columns)) == result(edges)
    assert back.filter(F.col("bucket") != F.pmod(F.xxhash64("article"), F.lit(4))).count() == 0
    for file in Path(path).rglob("*.parquet"):
        rows = [(r.article, r.valid_to) for r in spark.read.parquet(str(file)).collect()]
        assert rows == sorted(rows)


def test_text_lines(spark, edges, tmp_path):
    bucketed, single = str(tmp_path / "b"), str(tmp_path / "a")
    W.write_edges(edges, bucketed, format="text", buckets=3)
    lines = [r.value for r in spark.read.text(bucketed).collect()]
    assert "A B/Ü\t[2020-01-01T00:01:00,2020-01-01T00:02:00] X Y 1" in lines
    assert len(lines) == edges.count()

    W.write_edges(edges, single, layout="article", format="text")
    assert sorted(r.value for r in spark.read.text(single).collect()) == sorted(lines)
    (row,) = W.read_article(spark, single, "A B/Ü", format="text").collect()
    assert row.value == "A B/Ü\t[2020-01-01T00:01:00,2020-01-01T00:02:00] X Y 1"


def test_articles_that_differ_in_spaces_stay_apart(spark, tmp_path):
    histories = {"A B": [(1, at(1), {"X": 1}), (2, at(2), {})], "AB": [(3, at(3), {"X": 1}), (4, at(4), {})]}
    df, path = temporal_edges(*frames(spark, histories)), str(tmp_path / "a")
    W.write_edges(df, path, layout="article", format="text")
    assert {r.value.split("\t")[0] for r in spark.read.text(path).collect()} == {"A B", "AB"}
    places = W.article_manifest(spark, path).orderBy("article").collect()
    assert [(r.file_key, r.article, r.first_row, r.n_rows) for r in places] == [("AB", "A B", 0, 1), ("AB", "AB", 1, 1)]
    assert {r.value.split("\t")[0] for r in W.read_article(spark, path, "AB", format="text").collect()} == {"A B", "AB"}


def lines_of(file, format, spark):
    table = spark.read.format(format).load(file)
    return table.coalesce(1).collect()


@pytest.mark.parametrize("format", ["parquet", "text"])
def test_manifest_addresses_every_article(spark, edges, tmp_path, format):
    path = str(tmp_path / "m")
    W.write_edges(edges, path, layout="article", format=format, buckets=5)
    held = {}
    for place in W.article_manifest(spark, path).collect():
        rows = lines_of(unquote(place.file), format, spark)[place.first_row : place.first_row + place.n_rows]
        names = {r.article if format == "parquet" else r.value.split("\t")[0] for r in rows}
        assert names == {place.article} and len(rows) == place.n_rows
        held[place.article] = held.get(place.article, 0) + place.n_rows
    assert held == {r.article: r["count"] for r in edges.groupBy("article").count().collect()}


def test_one_article_is_read_from_its_own_files(spark, edges, tmp_path):
    path = str(tmp_path / "one")
    W.write_edges(edges, path, layout="article", buckets=7)
    name = edges.orderBy("article").first().article
    one = W.read_article(spark, path, name)
    assert result(one) == result(edges.filter(F.col("article") == name))
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    files = len(list(Path(path).glob("bucket=*/*.parquet")))
    assert scan.metrics().get("numFiles").get().value() == 1 < files
    assert W.read_article(spark, path, "no such article").count() == 0


def test_a_hot_article_may_be_in_several_files(spark, tmp_path):
    edges = spark.range(3000).selectExpr(
        "if(id % 3 = 0, concat('b', id % 50), 'hot one') as article", "concat('t', id) as target", "1L as cnt",
        "timestamp_ntz'2020-01-01 00:00:00' as valid_from", "timestamp_ntz'2020-01-02 00:00:00' as valid_to",
    )
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "700")
    try:
        W.write_edges(edges, path, layout="article", buckets=2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    places = W.article_manifest(spark, path).filter("article = 'hot one'").collect()
    assert len(places) > 1 and sum(p.n_rows for p in places) == 2000
    assert W.read_article(spark, path, "hot one").count() == 2000


def test_existing_output_is_not_overwritten(edges, tmp_path):
    path = str(tmp_path / "out")
    W.write_edges(edges, path)
    with pytest.raises(Exception, match="(?i)exists"):
        W.write_edges(edges, path)
    with pytest.raises(ValueError):
        W.write_edges(edges, str(tmp_path / "x"), layout="other")


def pages(spark, n):
    return spark.range(n).selectExpr(
        "id as page_id", "concat('T ', id) as title", "concat('<page>', id, '</page>') as block"
    )


def test_split_pages(spark, tmp_path):
    shuffled = pages(spark, 95).orderBy(F.xxhash64("page_id"))
    path = str(tmp_path / "split")
    W.split_pages(shuffled, path, ["page_id"], pages_per_bucket=10)
    rows = spark.read.parquet(path).orderBy("n").collect()
    assert [(r.n, r.page_file, r.block, r.bucket) for r in rows] == [
        (i, f"{i}-T {i}.xml", f"<page>{i}</page>", i // 10) for i in range(95)
    ]
    single = str(tmp_path / "single")
    W.split_pages(shuffled, single, ["page_id"], layout="page")
    back = spark.read.text(single)
    assert {(r.page_file, r.value) for r in back.collect()} == {
        (f"{i}-T {i}.xml", f"<page>{i}</page>") for i in range(95)
    }
    with pytest.raises(ValueError):
        W.split_pages(shuffled, single, ["page_id"], layout="other")


@pytest.mark.parametrize(("skip", "take"), [(0, 4), (10, 20), (90, 20), (200, 5), (7, None), (0, 0)])
def test_page_slice(spark, skip, take, monkeypatch):
    shuffled = pages(spark, 95).orderBy(F.xxhash64("page_id"))
    want = list(range(95))[skip : None if take is None else skip + take]
    for bound in (10_000, -1):
        monkeypatch.setattr("chronolink.operators.slicing.TOP_K_ROWS", bound)
        got = page_slice(shuffled, ["page_id"], skip=skip, take=take).select("page_id").collect()
        assert sorted(r.page_id for r in got) == want
