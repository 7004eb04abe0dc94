import pytest
from histories import at, frames, ordered, random_histories, result, walk_changes, walk_edges
from pyspark.sql import functions as F

from chronolink.operators import revisions as R


@pytest.mark.parametrize("hot_rows", [4, 100_000])
def test_changes_match_set_operations(spark, hot_rows):
    histories = random_histories(5)
    changes = R.link_changes(*frames(spark, histories), hot_rows=hot_rows)
    want = walk_changes(histories)
    assert result(changes) == want
    assert R.removed(changes).count() == len(walk_edges(histories))
    assert R.merged(changes).count() == sum(row[-1] != "removed" for row in want)
    assert R.kept(changes).columns == ["article", "rev_id", "ts", "target", "cnt"]
    assert R.added(changes).count() == sum(row[-1] == "added" for row in want)


def test_delta_arrays_keep_empty_revisions(spark):
    history = {"A": [(1, at(1), {}), (2, at(2), {"B": 1, "C": 1}), (3, at(3), {"B": 2, "C": 1})]}
    rows = R.link_delta(*frames(spark, history)).orderBy("rev_id").collect()
    got = [[[tuple(x) for x in row[n]] for n in ("kept", "removed", "added", "merged")] for row in rows]
    assert got == [
        [[], [], [], []],
        [[], [], [("B", 1), ("C", 1)], [("B", 1), ("C", 1)]],
        [[("C", 1)], [("B", 1)], [("B", 2)], [("B", 2), ("C", 1)]],
    ]


@pytest.mark.parametrize("hot_rows", [4, 100_000])
def test_history_parts_in_order_are_the_whole_history(spark, hot_rows):
    histories = random_histories(6)
    revisions, links = frames(spark, histories)
    rev_links = revisions.join(
        links.groupBy("article", "rev_id").agg(F.collect_list(F.struct("target", "cnt")).alias("links")),
        ["article", "rev_id"],
        "left",
    )
    parts = R.article_history(rev_links, part_size=5, hot_rows=hot_rows).collect()
    assert max(len(p.revisions) for p in parts) == 5
    for article, revs in histories.items():
        mine = sorted((p for p in parts if p.article == article), key=lambda p: p.part)
        flat = [(r.rev_id, r.ts) for p in mine for r in p.revisions]
        assert flat == [(rev_id, ts) for rev_id, ts, _ in ordered(revs)]


def test_order_and_group(spark):
    history = {"A": [(2, at(5), {}), (1, at(5), {}), (3, at(1), {})], "B": [(9, at(2), {"X": 1})]}
    revisions, _ = frames(spark, history)
    assert result(R.order_revisions(revisions)) == [
        ("A", 1, at(5), 2, at(5)),
        ("A", 2, at(5), 3, None),
        ("A", 3, at(1), 1, at(5)),
        ("B", 9, at(2), 1, None),
    ]
    assert result(R.group_revisions(revisions)) == [("A", 3, at(1), at(5)), ("B", 1, at(2), at(2))]


def test_after_is_strict(spark):
    revisions, _ = frames(spark, {"A": [(1, at(0), {}), (2, at(1), {"X": 1})]})
    assert [r.rev_id for r in R.after(revisions, "2020-01-01 00:00:00").collect()] == [2]
    assert R.after(revisions, F.lit(at(1)).cast("timestamp_ntz")).count() == 0
