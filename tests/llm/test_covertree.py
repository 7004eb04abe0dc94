import numpy as np
import pytest

from chronolink.llm import covertree
from chronolink.llm.components import local_components
from chronolink.llm.covertree import CoverTree, links_between, traverse


def points_of(rng, n, dim=8, groups=6):
    centres = rng.normal(size=(groups, dim))
    x = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.3, 2.0], (n, 1))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def brute(points, cosine=0.9):
    hit = points @ points.T >= cosine
    np.fill_diagonal(hit, False)
    return hit.sum(1), local_components(len(points), *np.nonzero(hit))


@pytest.mark.parametrize("seed", range(5))
def test_tree_levels_and_cover(seed):
    points = points_of(np.random.default_rng(seed), 300)
    tree = CoverTree.build(points, 40)
    far = covertree.distances(tree.centres, tree.centres)
    for k in range(1, len(tree.centres)):
        radius = 2.0 ** (1 - tree.level[k])
        earlier = far[k, :k][tree.level[:k] <= tree.level[k]]
        assert earlier.min() > radius - 1e-9  # separated at its level
        assert far[k, tree.parent[k]] <= 2 * radius + 1e-9  # covered by the level above
        assert tree.level[tree.parent[k]] < tree.level[k]
    to_leaf = covertree.distances(points, tree.centres)[np.arange(300), tree.leaf]
    tree.cover(np.array([to_leaf[tree.leaf == k].max(initial=0) for k in range(len(tree.centres))]))
    for k in range(len(tree.centres)):
        below, work = [], [k]
        while work:
            below.append(at := work.pop())
            work.extend(tree.under[at])
        own = points[np.isin(tree.leaf, below)]
        assert covertree.distances(own, tree.centres[k : k + 1]).max(initial=0) <= tree.radius[k] + 1e-7
    pairs = {tuple(p) for p in traverse(tree, tree, covertree.limit_of(0.9)).tolist()}
    hit = np.argwhere(points @ points.T >= 0.9)
    assert {(tree.leaf[i], tree.leaf[j]) for i, j in hit} <= pairs


@pytest.mark.parametrize("seed", range(5))
def test_blocks_against_brute_force(seed):
    rng = np.random.default_rng(seed)
    points = points_of(rng, 400)
    count = rng.integers(1, 4, 400)
    hit = points @ points.T >= 0.9
    np.fill_diagonal(hit, False)
    total, label = links_between(points, None, count, None, 0.9)
    assert total.tolist() == (hit @ count).tolist()
    assert label.tolist() == brute(points)[1].tolist()
    total, label = links_between(points[:150], points[150:], count[:150], count[150:], 0.9)
    cross = hit.copy()
    cross[:150, :150] = cross[150:, 150:] = False
    assert total.tolist() == (cross @ count).tolist()
    assert label.tolist() == local_components(400, *np.nonzero(cross)).tolist()


def run(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in covertree.near_duplicates(df).collect()}


def test_table_in_many_blocks(table, monkeypatch):
    for name in ("LEAF_ROWS", "BLOCK"):
        monkeypatch.setattr(covertree, name, 40)
    points = points_of(np.random.default_rng(9), 300)
    points[50:120] = points[50]  # copies
    got = run(table([(k, p.tolist()) for k, p in enumerate(points)], "vec_id long, embedding array<double>"))
    links, label = brute(points)
    assert [got[k][:2] for k in range(300)] == list(zip(links.tolist(), label.tolist(), strict=True))
    assert all(got[k][2] == (got[k][1] == k) for k in range(300))


def test_unusable_vectors(table):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1e200, 1e190]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1e-200, 0.0]), (None, [1.0, 0.0]),
    ]
    got = run(table([(*r, "x") for r in rows], "vec_id long, embedding array<double>, node string"))
    for k in (1, 2, 3, 11):
        assert got[k] == (3, 1, k == 1)
    for k in (4, 5, 6, 7, 8, 9, 10):
        assert got[k] == (0, k, True)
    assert got[None] == (0, None, True)


def test_all_lengths(table):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, [1.0, 0.0, 0.0]), (5, [1.0, 0.0, 0.0]), (6, [2.0])]
    rows += [(7, [3.0]), (8, [-1.0]), (9, [1.0, 0.0, 0.0, 0.0])]
    got = run(table(rows, "vec_id long, embedding array<double>"))
    assert got == {
        1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), 6: (1, 6, True),
        7: (1, 6, False), 8: (0, 8, True), 9: (0, 9, True),
    }


def test_rows_that_share_an_id_are_vectors_of_their_own(table):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.01, 1.0]), (1, [1.0, 0.0])]
    found = covertree.near_duplicates(table(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False)]


def test_empty_table(table):
    assert run(table([], "vec_id long, embedding array<float>")) == {}


def test_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    points = np.array([r["embedding"] for r in rows], float)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    links, label = brute(points)
    got = {r["vec_id"]: r for r in covertree.op3_embedding_dedup(spark, "/root/testdata/sf0.001").collect()}
    for k, r in enumerate(rows):
        assert got[r["vec_id"]]["n_links"] == links[k]
        assert got[r["vec_id"]]["component_id"] == rows[label[k]]["vec_id"]
