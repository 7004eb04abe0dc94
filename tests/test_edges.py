import pytest
from histories import at, frames, random_histories, result, walk_edges
from pyspark.sql import functions as F

from chronolink.operators.edges import (
    distinct_links,
    temporal_edges,
    temporal_edges_from_arrays,
)

HOT = [3, 100_000]


def arrays(revisions, links):
    gathered = links.groupBy("article", "rev_id").agg(
        F.collect_list(F.struct("target", "cnt")).alias("links")
    )
    return revisions.join(gathered, ["article", "rev_id"], "left")


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize("include_open", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_same_edges_as_walking_the_history(spark, seed, include_open, hot_rows):
    histories = random_histories(seed)
    revisions, links = frames(spark, histories)
    options = {"include_open": include_open, "hot_rows": hot_rows}
    want = walk_edges(histories, include_open)
    assert result(temporal_edges(revisions, links, **options)) == want
    assert result(temporal_edges_from_arrays(arrays(revisions, links), **options)) == want


@pytest.mark.parametrize("hot_rows", HOT)
def test_tasks_get_bounded_shares_of_the_rows(spark, monkeypatch, hot_rows):
    """More rows make more tasks, not larger ones, whatever the usual number of partitions."""
    monkeypatch.setattr("chronolink.operators.edges.TASK_ROWS", 20)
    histories = random_histories(3)
    revisions, links = frames(spark, histories)
    tasks = -(-(revisions.count() + links.count()) // 20)
    for edges in (
        temporal_edges(revisions, links, hot_rows=hot_rows),
        temporal_edges_from_arrays(arrays(revisions, links), hot_rows=hot_rows),
    ):
        assert edges.rdd.getNumPartitions() >= tasks > 20
        assert result(edges) == walk_edges(histories)


@pytest.mark.parametrize("hot_rows", HOT)
@pytest.mark.parametrize(
    ("found", "want"),
    [
        # The links of the three revisions and the closed edges.
        (
            [{"B": 2, "C": 1}, {"B": 1, "C": 1}, {"C": 1}],
            [("B", 1, 2, 3), ("B", 2, 1, 2)],
        ),
        # One revision: nothing follows, so nothing is closed.
        ([{"B": 1}], []),
        # A count that changes and comes back makes two edges.
        ([{"B": 2}, {"B": 1}, {"B": 2}, {}], [("B", 1, 2, 3), ("B", 2, 1, 2), ("B", 2, 3, 4)]),
        # A revision without links closes all.
        ([{"B": 1, "C": 1}, {}, {"B": 1}, {}], [("B", 1, 1, 2), ("B", 1, 3, 4), ("C", 1, 1, 2)]),
        # Revisions without links at the start are passed over.
        ([{}, {}, {"B": 1}, {"C": 1}], [("B", 1, 3, 4)]),
        # No revision has links.
        ([{}, {}], []),
        # A long run over many slices.
        ([{"B": 1}] * 11 + [{}], [("B", 1, 1, 12)]),
    ],
)
def test_cases(spark, found, want, hot_rows):
    history = {"A": [(n, at(n), links) for n, links in enumerate(found, 1)]}
    # An empty list of links has no row to take types from, so another article adds some.
    history["Z"] = [(100, at(1), {"X": 1})]
    revisions, links = frames(spark, history)
    edges = temporal_edges(revisions, links, hot_rows=hot_rows).filter("article = 'A'")
    assert result(edges) == sorted((("A", t, c, at(a), at(b)) for t, c, a, b in want), key=repr)


def test_equal_times_give_an_edge_without_length(spark):
    history = {"A": [(1, at(5), {"B": 1}), (2, at(5), {"C": 1}), (3, at(6), {"C": 1})]}
    assert result(temporal_edges(*frames(spark, history))) == [("A", "B", 1, at(5), at(5))]


def test_distinct_links_keep_the_first_time(spark):
    history = {"A": [(1, at(1), {"B": 1}), (2, at(2), {"B": 2}), (3, at(3), {"B": 1})]}
    assert result(distinct_links(*frames(spark, history))) == [
        ("A", "B", 1, at(1)),
        ("A", "B", 2, at(2)),
    ]
