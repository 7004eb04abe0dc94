"""Near duplicates among embeddings: a cover tree, traversed against itself.

On unit vectors cosine >= 0.9 is distance <= sqrt(0.2). A tree over a bounded sample has nested levels of centres with
halving radii; every vector goes to the nearest leaf centre, and each node then gets the exact radius that covers all
vectors under it. Two nodes are pruned as soon as their distance less both radii is above the limit. The pairs of leaves
that are left are compared in Spark, in blocks of bounded size; each block builds a tree of its own and the
traversal goes on between the two trees. There, pairs of nodes that lie so close that all their vectors must be linked are
taken as a whole, and for the rest cosines are computed in double precision. The sample decides which leaves there
are, never which pairs are found.

Equal vectors are one class with a count. A block gives for each of its classes the number of links and one mate in
its local component, so a group of near copies costs rows in proportion to its members, not to its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolink.plans.staging import stage

from .components import components, local_components
from .tables import read, small

COSINE = 0.9
#: Vectors that the tree is built on, leaves of the tree, vectors of a leaf that it is planned for.
SAMPLE = 8192
LEAVES = 1024
LEAF_ROWS = 4096
#: Vectors of a part of a leaf, and centres of the tree inside a block.
BLOCK = 4096
BLOCK_LEAVES = 32
#: Distances are trusted to this; what is nearer to a bound is computed.
SLACK = 1e-7


def limit_of(cosine: float) -> float:
    """The largest distance of unit vectors with this cosine."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine)))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


@dataclass
class CoverTree:
    """Centres in the order they were chosen, each the farthest from those before it.

    The first centres down to any radius r are more than r apart and cover all points within r: these are the nested
    levels. ``level`` of a centre is the first radius, halving from 2, at which it is one; its ``parent`` is the
    nearest centre of the levels above. ``radius`` covers all points under a centre's node.
    """

    centres: np.ndarray
    level: np.ndarray
    parent: np.ndarray
    leaf: np.ndarray
    radius: np.ndarray | None = None

    @classmethod
    def build(cls, points: np.ndarray, leaves: int, finest: float = 0.0) -> CoverTree:
        """At most ``leaves`` centres, none nearer than ``finest`` to another; points go to their nearest."""
        chosen, apart = [0], [np.inf]
        nearest, leaf = distances(points, points[:1])[:, 0], np.zeros(len(points), int)
        while len(chosen) < leaves:
            far = int(nearest.argmax())
            if nearest[far] <= max(finest, SLACK):
                break
            own = distances(points, points[far : far + 1])[:, 0]
            leaf[own < nearest] = len(chosen)
            apart.append(float(nearest[far]))
            chosen.append(far)
            nearest = np.minimum(nearest, own)
        centres = points[chosen]
        level = np.array([0 if not np.isfinite(d) else max(1, 1 + int(np.floor(1 - np.log2(d)))) for d in apart])
        parent = np.zeros(len(chosen), int)
        for k in range(1, len(chosen)):
            above = np.flatnonzero(level[:k] < level[k])
            parent[k] = above[distances(centres[k : k + 1], centres[above])[0].argmin()]
        return cls(centres, level, parent, leaf)

    def cover(self, leaf_radius: np.ndarray) -> None:
        """Set the radius of every node from what its leaf holds and from the nodes under it."""
        self.radius = leaf_radius.copy()
        self.under: list[list[int]] = [[] for _ in self.centres]
        for k in range(len(self.centres) - 1, 0, -1):
            p = self.parent[k]
            self.under[p].append(k)
        for k in sorted(range(1, len(self.centres)), key=lambda k: -self.level[k]):
            p = self.parent[k]
            reach = float(distances(self.centres[p : p + 1], self.centres[k : k + 1])[0, 0]) + self.radius[k]
            self.radius[p] = max(self.radius[p], reach)
        self.own = leaf_radius


def traverse(a: CoverTree, b: CoverTree, limit: float) -> np.ndarray:
    """Pairs of leaves that may hold vectors within the limit.

    A pair of nodes is pruned by its covering radii; else the node with the larger radius gives way to its own leaf
    and to the nodes under it.
    """
    far = distances(a.centres, b.centres)
    found: list[tuple[int, int]] = []
    work = [(0, False, 0, False)]  # node or its own leaf only, on either side
    while work:
        p, p_leaf, q, q_leaf = work.pop()
        p_radius = a.own[p] if p_leaf else a.radius[p]
        q_radius = b.own[q] if q_leaf else b.radius[q]
        if far[p, q] - p_radius - q_radius > limit + SLACK:
            continue
        if p_leaf and q_leaf:
            found.append((p, q))
        elif q_leaf or (not p_leaf and p_radius >= q_radius):
            work.append((p, True, q, q_leaf))
            work.extend((k, False, q, q_leaf) for k in a.under[p])
        else:
            work.append((p, p_leaf, q, True))
            work.extend((p, p_leaf, k, False) for k in b.under[q])
    return np.array(found, int).reshape(-1, 2)


def _tree(points: np.ndarray) -> tuple[CoverTree, list[np.ndarray]]:
    tree = CoverTree.build(points, BLOCK_LEAVES)
    to_leaf = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", points, tree.centres[tree.leaf]), 0))
    held = [np.flatnonzero(tree.leaf == k) for k in range(len(tree.centres))]
    tree.cover(np.array([to_leaf[h].max() if len(h) else 0.0 for h in held]))
    return tree, held


def links_between(a: np.ndarray, b: np.ndarray | None, count_a, count_b, cosine: float):
    """Of two blocks (one against itself if ``b`` is None): weighted number of links per row, component labels.

    Rows of ``b`` are numbered after those of ``a``.
    """
    limit = limit_of(cosine)
    same = b is None
    tree_a, held_a = _tree(a)
    tree_b, held_b = (tree_a, held_a) if same else _tree(b)
    b, count_b = (a, count_a) if same else (b, count_b)
    shift = 0 if same else len(a)
    n = shift + len(b)
    total = np.zeros(n, np.int64)
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    pairs = traverse(tree_a, tree_b, limit)
    far = distances(tree_a.centres, tree_b.centres)
    for p in np.unique(pairs[:, 0]):
        rows = held_a[p]
        others = pairs[pairs[:, 0] == p, 1]
        sure = far[p, others] + tree_a.own[p] + tree_b.own[others] < limit - SLACK
        for q in others[sure]:  # all linked
            cols = held_b[q]
            total[rows] += count_b[cols].sum()
            if not same:
                total[cols + shift] += count_a[rows].sum()
            group = np.concatenate([rows, cols + shift])
            ends.append((group, np.full(len(group), group.min())))
        if sure.all():
            continue
        cols = np.concatenate([held_b[q] for q in others[~sure]])
        hit = a[rows] @ b[cols].T >= cosine
        total[rows] += hit @ count_b[cols]
        if not same:
            total[cols + shift] += count_a[rows] @ hit
        i, j = np.nonzero(hit)
        if len(i):
            numbers = np.concatenate([rows, cols + shift])
            order, back = np.unique(numbers, return_inverse=True)
            label = local_components(len(order), back[i], back[len(rows) + j])
            ends.append((order, order[label]))
    if same:
        total -= count_a  # every row has met itself
    label = np.arange(n)
    if ends:
        label = local_components(n, *(np.concatenate(e) for e in zip(*ends, strict=True)))
    return total, label


def _prepare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors as bytes of doubles, with a digest; others with nulls."""
    for batch in small(batches, 4096):
        vectors, digests = [], []
        for values in batch["vector"]:
            own = None if not values.is_valid else values.values.to_numpy(zero_copy_only=False).astype("<f8")
            if own is not None:
                with np.errstate(all="ignore"):
                    size = np.sqrt(own @ own)
                    if not len(own) or not np.isfinite(own).all() or size == 0 or not np.isfinite(size):
                        # Very large or small numbers: scale first.
                        top = np.abs(own).max() if len(own) and np.isfinite(own).all() else 0.0
                        own = own / top if top > 0 else None
            vectors.append(None if own is None else own.tobytes())
            digests.append(None if own is None else hashlib.md5(own.tobytes(), usedforsecurity=False).digest())
        arrays = [batch["vec_id"], pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "digest", "v"])


def _units(values: list[bytes]) -> np.ndarray:
    rows = np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _to_leaves(sent):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = sent.value
        for batch in small(batches, 2048):
            points = _units(batch["v"].to_pylist())
            far = distances(points, centres)
            leaf = far.argmin(1)
            arrays = [batch[c] for c in ("node", "count", "v")]
            arrays += [pa.array(leaf, pa.int32()), pa.array(far[np.arange(len(leaf)), leaf])]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "count", "v", "leaf", "far"])

    return run


def _compare(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        first = table["unit"].to_numpy() == table["lo"][0].as_py()
        node, count = table["node"].to_numpy(), table["count"].to_numpy()
        points = _units(table["v"].to_pylist())
        same = table["lo"][0].as_py() == table["hi"][0].as_py()
        if same:
            total, label = links_between(points, None, count, None, cosine)
        elif first.all() or not first.any():
            return table.select(["node"]).slice(0, 0).append_column("n", pa.array([], pa.int64())).append_column(
                "mate", pa.array([], pa.int64())
            )
        else:
            order = np.concatenate([np.flatnonzero(first), np.flatnonzero(~first)])
            node, count, points, k = node[order], count[order], points[order], int(first.sum())
            total, label = links_between(points[:k], points[k:], count[:k], count[k:], cosine)
        linked = np.flatnonzero(total > 0)
        return pa.table({"node": node[linked], "n": total[linked], "mate": node[label[linked]]})

    return run


def near_duplicates(
    vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE
) -> DataFrame:
    """Per vector ``vec_id``, ``n_links``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Vectors that are null, empty, zero or hold null or non-finite numbers or have no id are linked with nothing. Only
    vectors of equal length are compared, each length with a tree of its own. Rows that share an id are vectors of their own,
    named alike. An empty table gives an empty table; other columns are ignored.
    """
    spark = vectors.sparkSession
    plain = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    usable = F.expr("vec_id is not null and forall(vector, x -> x is not null)")
    plain = plain.withColumn("vector", F.when(usable, F.col("vector")))
    rows = stage(plain.mapInArrow(_prepare, "vec_id long, digest binary, v binary"), "vectors")
    # Equal vectors are one class. Its number, not an id that other rows may have too, names it among links.
    classes = stage(
        rows.filter("v is not null")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("count"), F.first("v").alias("v"))
        .withColumns({"node": F.monotonically_increasing_id(), "length": F.octet_length("v")}),
        "vector-classes",
    )
    lengths = [r["length"] for r in classes.select("length").distinct().orderBy("length").collect()]
    links = [_linked(spark, classes.filter(F.col("length") == n), cosine) for n in lengths]
    none = spark.range(0).selectExpr("id as node", "id as n", "id as mate")
    found = stage(reduce(DataFrame.unionByName, links, none), "vector-links")

    totals = found.groupBy("node").agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("node").alias("a"), F.col("mate").alias("b")))
    members = classes.select("digest", "node", "count", "vec_id").join(joined, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node"))
    names = members.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    summary = (
        members.join(totals, "node", "left")
        .join(names, "component")
        .select("digest", (F.coalesce("n", F.lit(0)) + F.col("count") - 1).alias("n_links"), "component_id")
    )
    result = rows.select("vec_id", "digest").join(summary, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return result.select(
        F.col("vec_id").alias(id),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component.eqNullSafe(F.col("vec_id")), F.lit(True)).alias("kept"),
    )


def _linked(spark: SparkSession, classes: DataFrame, cosine: float) -> DataFrame:
    """(node, n, mate) of classes with links to others, once per block they were compared in."""
    schema = "node long, n long, mate long"
    sample = [bytes(r["v"]) for r in classes.orderBy(F.xxhash64("digest")).select("v").limit(SAMPLE).collect()]
    if not sample:
        return spark.range(0).selectExpr("id as node", "id as n", "id as mate")
    leaves = min(LEAVES, max(1, classes.count() // LEAF_ROWS))
    tree = CoverTree.build(_units(sample), leaves)
    sent = spark.sparkContext.broadcast(tree.centres)  # LEAVES vectors at most
    placed = stage(
        classes.select("node", "count", "v").mapInArrow(
            _to_leaves(sent), "node long, count long, v binary, leaf int, far double"
        ),
        "leaves",
    )
    held = placed.groupBy("leaf").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("rows")).collect()
    radius, parts = np.zeros(len(tree.centres)), np.zeros(len(tree.centres), int)
    for h in held:
        radius[h["leaf"]], parts[h["leaf"]] = h["far"], -(-h["rows"] // BLOCK)
    tree.cover(radius)
    pairs = traverse(tree, tree, limit_of(cosine))
    mates: dict[int, set[int]] = {}
    for p, q in pairs.tolist():
        mates.setdefault(p, set()).add(q)
        mates.setdefault(q, set()).add(p)
    # LEAVES rows of LEAVES numbers at most.
    with_mates = spark.createDataFrame(
        [(p, int(parts[p]), [(q, int(parts[q])) for q in sorted(m)]) for p, m in mates.items()],
        "leaf int, parts int, mates array<struct<leaf:int,parts:int>>",
    )
    unit = "leaf * 16777216L + pmod(xxhash64(node), parts)"
    others = "flatten(transform(mates, m -> transform(sequence(0, m.parts - 1), p -> m.leaf * 16777216L + p)))"
    return (
        placed.select("node", "count", "v", "leaf")
        .join(F.broadcast(with_mates), "leaf")
        .filter("parts > 0")
        .withColumn("mates", F.expr("filter(mates, m -> m.parts > 0)"))
        .select("node", "count", "v", F.expr(unit).alias("unit"), F.explode(F.expr(others)).alias("other"))
        .withColumns({"lo": F.least("unit", "other"), "hi": F.greatest("unit", "other")})
        .drop("other")
        .groupBy("lo", "hi")
        .applyInArrow(_compare(cosine), schema)
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "embeddings"))


#: All pairs, and all that links reach.
ORACLE = f"""
with recursive vector as (
  select vec_id, list_transform(e, lambda x: x / length) as e from (
    select *, sqrt(list_inner_product(e, e)) as length from (
      select vec_id, cast(embedding as double[]) as e from embeddings
      where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)))
  where length > 0),
link as (
  select a.vec_id as x, b.vec_id as y from vector a join vector b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    and list_inner_product(a.e, b.e) >= {COSINE}),
reach(x, y) as (select x, y from link union select reach.x, link.y from reach join link on reach.y = link.x),
linked as (select x, count(*) as n from link group by x),
first as (select x, min(y) as y from reach group by x)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, first.y) as component_id,
  vec_id = least(vec_id, first.y) as kept
from embeddings left join linked on linked.x = vec_id left join first on first.x = vec_id
"""
