"""Near duplicates among documents by SetSketch registers over word shingles.

A document is the set of its distinct shingles of five words. A register keeps the smallest of the exponential values
that its hash function gives the shingles, on a logarithmic scale cut to 16 bits: sketches merge by maximum, and registers
of similar sets agree about as often as the sets do. Bands of registers make buckets; pairs that share a bucket are
estimated jointly by likelihood from their registers and sizes, and those that might be similar enough are verified on
their full shingle sets.

Documents with equal sets are one class from the start. In its buckets every class first meets a few leaders, those that
it shares most buckets with. What these links leave apart is compared by registers, block by block, whatever the size of
the bucket: classes of different components that look alike form a cluster. Then the full sets of each cluster meet, again
in blocks of bounded size, and every promising pair across components is verified. So a group of near copies costs rows
in proportion to its members, and no pair that shares a bucket is left open.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolink.plans.staging import stage

from .components import components, local_components
from .tables import read, small

WORDS = 5
#: Documents are linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Registers, and registers of a band. A pair at the limit shares no bucket with probability 6e-6.
REGISTERS = 128
BAND = 4
#: The base of the scale of registers.
BASE = 1.001
#: Pairs with a likeliest similarity below this are not verified: four and a half deviations under the limit.
LEAST_ESTIMATE = 0.57
#: Leaders that a class meets in the first round, of all those of its buckets.
LEADERS = 8
#: Share of equal registers below which two classes do not look alike: six deviations under the limit.
LEAST_EQUAL = 0.52
#: Classes of a bucket or cluster that are compared at a time.
BLOCK = 512
#: Bits of the filter by which a scan tells documents that may be wanted, at most; 2 MB.
FILTER_BITS = 1 << 24

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(20240229).integers(0, 1 << 32, REGISTERS, dtype=np.uint32)
_FACTORS = np.random.default_rng(31415926).integers(0, 1 << 31, REGISTERS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


class _Words(dict):
    """Hashes of the words a worker has met; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_WORDS = _Words()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, size: int = WORDS) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a UTF-8 text; of fewer words, of all as one."""
    words = (text or b"").lower().split()  # of bytes: A-Z, and the six ASCII spaces
    if not words:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    size = min(size, len(one))
    count = len(one) - size + 1
    value = np.full(count, size, np.uint64)
    for k in range(size):
        value = value * _GOLD + one[k : k + count]
    return np.unique(_mixed(value))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers of a set of hashes."""
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 512):
        x = short[at : at + 512, None] ^ _SEEDS
        x *= _FACTORS
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        np.minimum(least, x.min(0), out=least)
    # The smallest of n exponential values of rate 1; larger registers for smaller values.
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32)
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, 65535).astype("<u2")


def merge(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(left, right)


_GRID = np.linspace(0, 1, 101)


def estimate(more: np.ndarray, less: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarities.

    ``more`` and ``less`` count registers that are larger on the left and on the right, ``left`` and ``right`` are
    the sizes of the sets.
    """
    whole = (left + right).astype(float)
    u, v = (left / whole)[:, None], (right / whole)[:, None]
    j = np.minimum(_GRID, np.minimum(u / v, v / u))

    def chance(x):
        return np.clip(-np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE), 1e-9, 1)

    above, below = chance(u - v * j), chance(v - u * j)
    same = np.clip(1 - above - below, 1e-9, 1)
    equal = (REGISTERS - more - less)[:, None]
    likelihood = more[:, None] * np.log(above) + less[:, None] * np.log(below) + equal * np.log(same)
    return j[np.arange(len(j)), likelihood.argmax(1)]


def promising(a: np.ndarray, b: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether pairs of register rows may be similar enough; their sizes must allow it in any case."""
    fits = 100 * np.minimum(left, right) >= PERCENT * np.maximum(left, right)
    found = np.zeros(len(a), bool)
    at = np.flatnonzero(fits)
    if len(at):
        more, less = (a[at] > b[at]).sum(1), (a[at] < b[at]).sum(1)
        found[at] = estimate(more, less, left[at], right[at]) >= LEAST_ESTIMATE
    return found


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets are similar enough."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


def _features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        sizes, digests, registers = [], [], []
        for text in batch["_text"].to_pylist():
            own = shingles(text)
            sizes.append(len(own))
            digests.append(hashlib.md5(own.tobytes(), usedforsecurity=False).digest() if len(own) else None)
            registers.append(sketch(own).tobytes() if len(own) else None)
        arrays = [batch["_id"], pa.array(sizes, pa.int64())]
        arrays += [pa.array(digests, pa.binary()), pa.array(registers, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n", "digest", "registers"])


def _rows(column, type: str = "<u2") -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), type).reshape(len(values), -1)


def _buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bands = REGISTERS // BAND
    names = np.arange(bands, dtype=np.uint64) * _GOLD
    for batch in small(batches, 4096):
        packed = np.ascontiguousarray(_rows(batch["registers"])).view("<u8")  # four registers of 16 bits
        keys = _mixed(packed.astype(np.uint64) ^ names).view(np.int64)
        nodes = np.repeat(batch["node"].to_numpy(zero_copy_only=False), bands)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["bucket", "node"])


def _promising(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 4096):
        a, b = _rows(batch["registers_a"]), _rows(batch["registers_b"])
        sizes = [batch[c].to_numpy(zero_copy_only=False) for c in ("n_a", "n_b")]
        keep = pa.array(promising(a, b, *sizes))
        yield pa.RecordBatch.from_arrays([batch[c].filter(keep) for c in ("a", "b")], ["a", "b"])


def _sets(sent):
    """Full sets of the documents that the filter lets through."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in batches:
            at = batch["_bit"].to_numpy(zero_copy_only=False)
            wanted = batch.filter(pa.array((bits[at >> 6] >> (at & 63)) & 1 != 0))
            for part in small([wanted]):
                sets = [shingles(t).tobytes() for t in part["_text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["_id"], pa.array(sets, pa.binary())], ["node", "set"])

    return run


def _filter(nodes: DataFrame) -> tuple[np.ndarray, int]:
    """A bit for each node, at a place its hash gives; the number of bits follows that of the nodes up to a bound."""
    size = min(FILTER_BITS, max(1 << 16, 1 << (16 * nodes.count()).bit_length()))
    place = _place("node", size)
    words = (
        nodes.select(place.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("v"))
    )
    bits = np.zeros(size >> 6, np.int64)
    for w, v in words.collect():  # FILTER_BITS / 64 rows at most
        bits[w] = v
    return bits, size


def _place(node: str, size: int):
    return F.xxhash64(node).bitwiseAND(F.lit(size - 1).cast("long"))


def _verified(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        sets = zip(batch["set_a"].to_pylist(), batch["set_b"].to_pylist(), strict=True)
        held = pa.array([similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in sets], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch[c].filter(held) for c in ("a", "b")], ["a", "b"])


class _Group:
    """Members of a row, as arrays; ``split`` says that they are two blocks to be compared with each other."""

    def __init__(self, members: pa.StructArray):
        self.node, self.comp, self.n, part = (
            members.field(c).to_numpy(zero_copy_only=False) for c in ("node", "c", "n", "part")
        )
        self.registers, self.part = _rows(members.field("registers")), part
        self.split = part.min() != part.max()

    def partners(self, k: int) -> np.ndarray:
        """Later members to compare with member ``k``: of another component, alike in size and registers."""
        at = np.arange(k + 1, len(self.node))
        keep = self.comp[at] != self.comp[k]
        if self.split:
            keep &= self.part[at] != self.part[k]
        n = self.n[at]
        keep &= 100 * np.minimum(n, self.n[k]) >= PERCENT * np.maximum(n, self.n[k])
        at = at[keep]
        equal = (self.registers[at] == self.registers[k]).sum(1)
        return at[equal >= LEAST_EQUAL * REGISTERS]


def _alike(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes that look like one of another component, linked to the first member they hang together with."""
    for batch in small(batches, 64):
        nodes, roots = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for members in batch["members"]:
            group = _Group(members.values)
            i, j = [], []
            for k in range(len(group.node) - 1):
                if len(at := group.partners(k)):
                    i.append(np.full(len(at), k))
                    j.append(at)
            if i:
                i, j = np.concatenate(i), np.concatenate(j)
                label = local_components(len(group.node), i, j)
                own = np.unique(np.concatenate([i, j]))
                nodes.append(group.node[own])
                roots.append(group.node[label[own]])
        arrays = [pa.array(np.concatenate(x), pa.int64()) for x in (nodes, roots)]
        yield pa.RecordBatch.from_arrays(arrays, ["a", "b"])


def _verified_across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components, by the full sets of the members of a cluster."""
    for batch in small(batches, 1):
        found: set[tuple[int, int]] = set()
        for members in batch["members"]:
            group = _Group(members.values)
            sets = [np.frombuffer(v, np.uint64) for v in members.values.field("set").to_pylist()]
            for k in range(len(group.node) - 1):
                at = group.partners(k)
                if len(at):
                    mine = np.broadcast_to(group.registers[k], (len(at), REGISTERS))
                    at = at[promising(mine, group.registers[at], np.full(len(at), group.n[k]), group.n[at])]
                for j in at[_shared_enough(sets[k], [sets[j] for j in at])]:
                    found.add((int(group.comp[k]), int(group.comp[j])))
        pairs = list(found)
        arrays = [pa.array([p[e] for p in pairs], pa.int64()) for e in (0, 1)]
        yield pa.RecordBatch.from_arrays(arrays, ["a", "b"])


def _shared_enough(own: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of the sets are similar enough to ``own``."""
    if not others:
        return np.empty(0, bool)
    sizes = np.array([len(o) for o in others])
    every = np.concatenate(others)
    place = np.minimum(np.searchsorted(own, every), len(own) - 1)
    shared = np.add.reduceat((own[place] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * shared >= PERCENT * (len(own) + sizes - shared)


def _both(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Add the columns of ``table`` for both nodes of the pairs."""
    for end in ("a", "b"):
        own = table.select(F.col("node").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns])
        pairs = pairs.join(own, end)
    return pairs


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Ids are longs. A null or empty text, or one of white space, has no shingles and is linked with nothing, and so
    is a row without an id. Rows that share an id are one document: what one of them is linked with, all are. An
    empty table gives an empty table; other columns are ignored.
    """
    plain = docs.select(F.col(id).cast("long").alias("_id"), F.col(text).cast("binary").alias("_text"))
    feats = plain.mapInArrow(_features, "doc_id long, n long, digest binary, registers binary")
    feats = stage(feats.withColumn("digest", F.expr("if(doc_id is null, null, digest)")), "sketches")
    reps = stage(
        feats.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("registers").alias("registers")),
        "classes",
    )
    buckets = reps.mapInArrow(_buckets, "bucket long, node long")

    # First round: every class of a bucket against two leaders.
    shared = (
        buckets.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.min("node").alias("lead"),
            F.min(F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("node"))).alias("other"),
        )
        .filter("size > 1")
    )
    shared = stage(
        buckets.join(shared.select("bucket", "size", "lead", F.col("other.node").alias("other")), "bucket"), "shared"
    )
    # A class has at most two leaders a band, so the window is over a few dozen rows.
    closest = Window.partitionBy("node").orderBy(F.desc("bands"), "lead")
    first = (
        shared.select("node", F.explode(F.array("lead", "other")).alias("lead"))
        .filter("node <> lead")
        .groupBy("node", "lead")
        .agg(F.count(F.lit(1)).alias("bands"))
        .withColumn("place", F.row_number().over(closest))
        .filter(F.col("place") <= LEADERS)
        .select(F.least("node", "lead").alias("a"), F.greatest("node", "lead").alias("b"))
        .distinct()
    )
    first = stage(_both(first, reps, ["registers", "n"]).mapInArrow(_promising, "a long, b long"), "pairs")
    links = stage(_verify(first, plain), "links")
    joined = stage(components(links), "components")

    # Second round: classes of a bucket that are in different components by now.
    placed = shared.join(joined, "node", "left").select(
        "bucket", "size", "node", F.coalesce("component", "node").alias("c")
    )
    mixed = placed.groupBy("bucket").agg(F.min("c").alias("_min"), F.max("c").alias("_max")).filter("_min <> _max")
    open_rows = placed.join(mixed.select("bucket"), "bucket", "left_semi").join(
        reps.select("node", "n", "registers"), "node"
    )
    columns = ["node", "c", "n", "part", "registers"]
    edges = _in_blocks(open_rows, "bucket", columns).mapInArrow(_alike, "a long, b long")
    clusters = components(edges).withColumnRenamed("component", "cluster")
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    clusters = stage(clusters.join(sizes, "cluster"), "clusters")
    members = (
        clusters.join(joined, "node", "left")
        .select("cluster", "size", "node", F.coalesce("component", "node").alias("c"))
        .join(reps.select("node", "n", "registers"), "node")
        .join(_sets_of(clusters.select("node"), plain), "node")
    )
    more = _in_blocks(members, "cluster", [*columns, "set"]).mapInArrow(_verified_across, "a long, b long")
    joins = components(more)
    joins = joins.select(F.col("node").alias("component"), F.col("component").alias("end"))
    final = stage(
        joined.join(joins, "component", "left").select("node", F.coalesce("end", "component").alias("component"))
        .unionByName(joins.select(F.col("component").alias("node"), F.col("end").alias("component")))
        .groupBy("node")
        .agg(F.min("component").alias("component")),
        "final-components",
    )

    classes = reps.select("digest", "node").join(final, "node", "left")
    classes = classes.select("digest", F.coalesce("component", "node").alias("component_id"))
    result = feats.select("doc_id", "n", "digest").join(classes, "digest", "left")
    component = F.coalesce("component_id", "doc_id")
    return result.select(
        F.col("doc_id").alias(id),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component.eqNullSafe(F.col("doc_id")), F.lit(True)).alias("kept"),
    )


def _in_blocks(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``members`` of a key (which has ``size`` rows) in pairs of blocks, so that any two come together once."""
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    part = F.pmod(F.xxhash64("node"), parts).cast("int")
    return (
        rows.select(
            key,
            *[c for c in columns if c != "part"],
            part.alias("part"),
            F.explode(F.sequence(F.lit(0), parts - 1)).alias("with"),
        )
        .groupBy(key, F.least("part", "with").alias("lo"), F.greatest("part", "with").alias("hi"))
        .agg(F.collect_list(F.struct(*columns)).alias("members"))
        .filter("size(members) > 1 and exists(members, m -> m.part = lo) and exists(members, m -> m.part = hi)")
        .select("members")
    )


def _sets_of(nodes: DataFrame, plain: DataFrame) -> DataFrame:
    """(node, set) of the wanted nodes, and of some others.

    The texts stay where they are: a filter of bounded size picks those to take sets of, and what it lets through by
    chance finds nothing to join.
    """
    bits, size = _filter(nodes)
    sent = plain.sparkSession.sparkContext.broadcast(bits)
    return plain.withColumn("_bit", _place("_id", size)).mapInArrow(_sets(sent), "node long, set binary")


def _verify(pairs: DataFrame, plain: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    wanted = stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    both = _both(pairs, _sets_of(wanted, plain), ["set"])
    return both.mapInArrow(_verified, "a long, b long").distinct()


def without_near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are the first of their group, with their own columns."""
    gone = near_duplicates(docs, id=id, text=text).filter("not kept").select(F.col(id).alias("_gone")).distinct()
    return docs.join(gone, docs[id] == gone["_gone"], "left_anti")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


#: Whole sets, all pairs that share a shingle, and all that links reach.
ORACLE = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
shingle as (
  select distinct doc_id, array_to_string(w[s : s + 4], ' ') as g
  from worded, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(s) where len(w) > 0),
size as (select doc_id, count(*) as n from shingle group by doc_id),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as n from shingle a join shingle b on a.g = b.g and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id),
pair as (
  select x, y from shared join size a on a.doc_id = x join size b on b.doc_id = y
  where 100 * shared.n >= 75 * (a.n + b.n - shared.n)),
link as (select x, y from pair union all select y, x from pair),
reach(x, y) as (select x, y from link union select reach.x, link.y from reach join link on reach.y = link.x),
first as (select x, min(y) as y from reach group by x)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, first.y) as component_id,
  d.doc_id = least(d.doc_id, first.y) as kept
from documents d left join size on size.doc_id = d.doc_id left join first on first.x = d.doc_id
"""
