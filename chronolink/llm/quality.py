"""Quality rules: base rules, and boosted trees over document statistics.

Every text is described once by numbers that are worked out over all of it. The base rules look at two of them. What they
pass is judged by gradient-boosted trees, fitted here on all labelled documents with histograms and second order steps: the
documents lie in blocks of binned features, tasks sum them up for each level of a tree, and only sums go to the driver. Features that only speak against a text (symbols, repeated lines and windows, shouting) are constrained: more
of them never raises the score. The trees lie in flat numpy arrays, so a lot of documents goes down all trees at once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from chronolink.plans.sequence import sorted_ranges
from chronolink.plans.staging import stage

from .tables import read, small

#: Labelled documents of a block, on average.
BLOCK = 8_192
ROUNDS, DEPTH, BINS, RATE, L2 = 60, 4, 64, 0.2, 1.0
#: Documents that a leaf needs.
LEAF = 10
#: Share of held-out good documents that the verdict keeps.
KEEP_SHARE = 0.995
SEED = 12

# Symbols and limits of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEAT = 50, 50
SPACE = " \t\n\v\f\r"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Features with 1 where more may only raise the score, -1 where it may only lower it, 0 where both is possible.
FEATURES = {
    "log_words": 0,
    "mean_word": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "upper": -1,
    "digits": 0,
    "shouts": -1,
    "commas": 0,
    "distinct_words": 0,
    "top_word": -1,
    "line_words": 0,
    "closed_lines": 0,
    "short_words": 0,
    "longest_word": 0,
    "not_ascii": 0,
}
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))


def _without(raw: bytes, chars: bytes) -> int:
    """How many bytes of ``raw`` are among ``chars``."""
    return len(raw) - len(raw.translate(None, chars))


def repeat_words(ids: np.ndarray) -> int:
    """Words inside a window of three that the text has twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    # Pairs are numbered first, so that no text is too long for exact keys.
    width = int(ids.max()) + 1
    _, pair = np.unique(ids[:-2] * width + ids[1:-1], return_inverse=True)
    _, which, times = np.unique(pair * width + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(times[which] > 1)
    hit = np.zeros(n, bool)
    for step in range(3):
        hit[starts + step] = True
    return int(hit.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """Counts of the base rules and features of a whole text; those of a null text are those of an empty one."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes are split at ASCII white space only
    n = len(words)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, n)
    lines = [line for line in text.split("\n") if line.strip(SPACE)]
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = _without(raw, SYMBOLS)
    dup = len(lines) - len(set(lines))
    repeated = repeat_words(ids)
    per = 1 / max(n, 1)
    lengths = np.fromiter(map(len, words), np.int64, n)
    features = [
        np.log1p(n),
        chars * per,
        symbols * per,
        dup / max(len(lines), 1),
        repeated * per,
        _without(raw, _UPPER) / max(chars, 1),
        _without(raw, _DIGITS) / max(chars, 1),
        _without(raw, b"!?") * per,
        _without(raw, b",;:") * per,
        len(known) * per,
        int(np.bincount(ids).max()) * per if n else 0.0,
        n / max(len(lines), 1),
        sum(line.rstrip(SPACE)[-1] in ".!?" for line in lines) / max(len(lines), 1),
        float((lengths <= 3).sum()) * per,
        np.log1p(int(lengths.max())) if n else 0.0,
        (len(raw) - len(text)) / max(len(raw), 1),
    ]
    return [n, chars, symbols, dup, repeated], features


def _base_failed(n_words: str, n_repeat: str) -> Column:
    return (F.col(n_words) < MIN_WORDS) | (100 * F.col(n_repeat) > MAX_REPEAT * F.col(n_words))


@dataclass
class Trees:
    """Trees in flat arrays: a node's children, a leaf its own child; ``roots`` is where each tree begins."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    threshold: float = 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of each row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            at = np.where(x[rows, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.base + self.value[at].sum(axis=1))))


@dataclass
class _Tree:
    """A tree over bins; a leaf is its own child. ``cut`` is the last bin on the left, ``limit`` its upper edge."""

    feature: list[int]
    cut: list[int]
    limit: list[float]
    left: list[int]
    right: list[int]
    value: list[float]

    def add(self) -> int:
        at = len(self.value)
        for column, v in zip(vars(self).values(), (0, 0, np.inf, at, at, 0.0), strict=True):
            column.append(v)
        return at

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node that each row is in."""
        feature, cut, left, right = map(np.array, (self.feature, self.cut, self.left, self.right))
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            at = np.where(bins[rows, feature[at]] <= cut[at], left[at], right[at])
        return at


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1).astype(np.uint8)


def _sums(bins, y, base: float, done: list[_Tree], tree: _Tree, nodes: list[int], depth: int) -> np.ndarray:
    """For each of the nodes of the tree: sums of gradients and hessians, then those and counts by feature and bin."""
    margin = np.full(len(y), base)
    for d in done:
        margin += np.array(d.value)[d.nodes(bins, depth)]
    p = 1 / (1 + np.exp(-margin))
    gradient, hessian = p - y, p * (1 - p)
    at, found = tree.nodes(bins, depth), []
    for node in nodes:
        rows = np.flatnonzero(at == node)
        g, h = gradient[rows], hessian[rows]
        found += [[g.sum(), h.sum()]]
        found += [np.bincount(bins[rows, j], w, BINS) for j in range(bins.shape[1]) for w in (g, h, None)]
    return np.concatenate(found).reshape(len(nodes), -1)


def _boost(edges: list[np.ndarray], base: float, signs: np.ndarray, sums, rounds: int, depth: int) -> Trees:
    """Trees grown level by level from ``sums(trees before, tree, nodes)``."""

    def weight(g, h, low, high):
        return np.clip(-g / (h + L2), low, high)

    def gain(g, h, w):
        return -(g * w + 0.5 * (h + L2) * w * w)

    done: list[_Tree] = []
    for _ in range(rounds):
        tree = _Tree([], [], [], [], [], [])
        level = [(tree.add(), -np.inf, np.inf)]
        for left_levels in range(depth, -1, -1):
            deeper = []
            for (at, low, high), found in zip(level, sums(done, tree, [n for n, *_ in level]), strict=True):
                (g, h), by_bin = found[:2], found[2:].reshape(len(edges), 3, BINS)
                own = weight(g, h, low, high)
                best = None
                for j, cuts in enumerate(edges if left_levels else []):
                    if not len(cuts):
                        continue
                    running = [w[: len(cuts) + 1].cumsum() for w in by_bin[j]]
                    gl, hl, nl = (s[:-1] for s in running)
                    gr, hr, nr = (s[-1] - part for s, part in zip(running, (gl, hl, nl), strict=True))
                    wl, wr = weight(gl, hl, low, high), weight(gr, hr, low, high)
                    better = gain(gl, hl, wl) + gain(gr, hr, wr) - gain(g, h, own)
                    fits = (nl >= LEAF) & (nr >= LEAF) & (signs[j] * (wr - wl) >= 0)
                    better = np.where(fits, better, 0.0)
                    k = int(better.argmax())
                    if better[k] > 1e-9 and (best is None or better[k] > best[0]):
                        best = (better[k], j, k, float(wl[k] + wr[k]) / 2)
                if best is None:
                    tree.value[at] = RATE * float(own)
                    continue
                _, j, k, middle = best
                left, right = tree.add(), tree.add()
                tree.feature[at], tree.cut[at], tree.limit[at] = j, k, float(edges[j][k])
                tree.left[at], tree.right[at] = left, right
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}
                deeper += [(side, *b) for side, b in zip((left, right), bounds[int(signs[j])], strict=True)]
            level = deeper
            if not level:
                break
        done.append(tree)
    starts = np.cumsum([0] + [len(t.value) for t in done])[:-1]
    flat = [np.concatenate([np.array(getattr(t, c)) for t in done]) for c in ("feature", "limit", "value")]
    left, right = (np.concatenate([np.array(getattr(t, c)) + s for t, s in zip(done, starts, strict=True)]) for c in ("left", "right"))
    return Trees(flat[0], flat[1], left, right, flat[2], starts, base)


def _base_margin(share: float) -> float:
    share = np.clip(share, 1e-6, 1 - 1e-6)
    return float(np.log(share / (1 - share)))


_QUANTILES = np.linspace(0, 1, BINS + 1)[1:-1]


def boost(x: np.ndarray, y: np.ndarray, signs: np.ndarray, *, rounds: int = ROUNDS, depth: int = DEPTH) -> Trees:
    """Boosted trees for the probability of ``y``, never against ``signs``.

    A split on a constrained feature is taken only if the values of its sides are in order; below it, both sides stay on
    their side of the middle between them.
    """
    edges = [np.unique(np.quantile(x[:, j], _QUANTILES)) for j in range(x.shape[1])]
    bins, base = _binned(x, edges), _base_margin(y.mean())
    return _boost(edges, base, signs, lambda *made: _sums(bins, y, base, *made, depth), rounds, depth)


def quantile_edges(rows: DataFrame, n: int) -> list[np.ndarray]:
    """For each feature of ``n`` rows with ``features``, the values that ``np.quantile`` gives for the edges of the bins.

    Values are counted and sorted into ranges; a value's first place is what ranges before it have, and it has as many as
    it is frequent. Only values at the places wanted leave Spark.
    """
    at = _QUANTILES * (n - 1)
    lower = np.floor(at).astype(int)
    upper = np.minimum(lower + 1, n - 1)
    values = rows.select(F.posexplode("features").alias("j", "v")).groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"))
    ranges = sorted_ranges(values, ["j", "v"])
    before = Window.partitionBy("j").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    parts = ranges.groupBy("j", "_range").agg(F.sum("n").alias("n"))
    parts = parts.select("j", "_range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("j", "_range").orderBy("_at")
    placed = ranges.join(parts, ["j", "_range"]).withColumn("upto", F.col("_before") + F.sum("n").over(inside))
    wanted = F.array(*[F.lit(int(r)) for r in sorted({*lower, *upper})])
    hit = F.exists(wanted, lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    found = [[] for _ in FEATURES]
    for r in placed.filter(hit).select("j", "v", "upto").orderBy("j", "upto").collect():
        found[r["j"]].append((r["upto"], r["v"]))
    edges = []
    for ends in found:
        upto, v = (np.array(c) for c in zip(*ends, strict=True))
        a, b = (v[np.searchsorted(upto, places, side="right")] for places in (lower, upper))
        t = at - lower
        edges.append(np.unique(np.where(t >= 0.5, b - (b - a) * (1 - t), a + (b - a) * t)))
    return edges


_SIGNS = np.array(list(FEATURES.values()))


def _blocks(rows: DataFrame, n: int, edges: list[np.ndarray]) -> DataFrame:
    """The rows in blocks of binned features, written; ``block`` gives them an order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, ys, first = [], [], None
        for batch in batches:
            if len(batch):
                first = batch["_order"][0].as_py() if first is None else first
                x = batch["features"].flatten().to_numpy().reshape(len(batch), len(edges))
                bins.append(_binned(x, edges).tobytes())
                ys.append(batch["_y"].to_numpy().astype(np.uint8).tobytes())
        if bins:
            columns = [pa.array([first], pa.int64()), *[pa.array([b"".join(p)], pa.binary()) for p in (bins, ys)]]
            yield pa.RecordBatch.from_arrays(columns, ["block", "bins", "y"])

    ranges = rows.repartitionByRange(-(-n // BLOCK), "_order").sortWithinPartitions("_order")
    binned = ranges.select("features", F.col("_y").cast("int").alias("_y"), "_order").mapInArrow(
        run, "block long, bins binary, y binary"
    )
    return stage(binned, "quality-blocks")


def fit(docs: DataFrame, labels: DataFrame) -> Trees | None:
    """Trees for ``quality`` of ``labels``, or None if a class has no labelled document that passes the base rules.

    All labelled documents with ``quality`` 0 or 1 count: those with an odd hash of their id choose the threshold, the lowest
    that keeps ``KEEP_SHARE`` of the good ones, 0.5 at most; the others are learned from. A document with different labels
    counts as bad; nulls are no labels.
    """
    order = F.xxhash64(F.lit(SEED), "doc_id")
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("_y"))
    known = known.filter("_y in (0, 1)").withColumn("_order", order)
    # Texts are described before they are joined, so that no text is shuffled.
    found = describe(docs).join(known, "doc_id").groupBy("doc_id", "_y", "_order")
    found = found.agg(F.min(F.struct(*COUNTS, "features")).alias("s")).filter(~_base_failed("s.n_words", "s.n_repeat_words"))
    rows = stage(found.select("_y", "_order", "s.features"), "quality-examples")
    learn, hold = (rows.filter(F.pmod("_order", F.lit(2)) == odd) for odd in (0, 1))
    sizes = {r["_y"]: r["count"] for r in learn.groupBy("_y").count().collect()}
    if len(sizes) < 2:
        return None
    n = sum(sizes.values())
    edges, base = quantile_edges(learn, n), _base_margin(sizes[1] / n)
    blocks = _blocks(learn, n, edges)

    def sums(done: list[_Tree], tree: _Tree, nodes: list[int]) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first, total = None, 0.0
            for batch in batches:
                for block, bins, y in zip(*(batch[c].to_pylist() for c in ("block", "bins", "y")), strict=True):
                    bins = np.frombuffer(bins, np.uint8).reshape(len(y), len(edges))
                    total = total + _sums(bins, np.frombuffer(y, np.uint8), base, done, tree, nodes, DEPTH)
                    first = block if first is None else first
            if first is not None:
                columns = [pa.array([first], pa.int64()), pa.array([total.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["block", "sums"])

        parts = sorted(blocks.mapInArrow(run, "block long, sums binary").collect(), key=lambda r: r["block"])
        return sum(np.frombuffer(r["sums"]).reshape(len(nodes), -1) for r in parts)

    trees = _boost(edges, base, _SIGNS, sums, ROUNDS, DEPTH)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch["features"].flatten().to_numpy().reshape(len(batch), len(edges))
                yield pa.RecordBatch.from_arrays([pa.array(trees.scores(x))], ["score"])

    good = hold.filter("_y = 1")
    if n_good := good.count():
        scored = good.select("features").mapInArrow(score, "score double").orderBy("score")
        trees.threshold = min(0.5, scored.offset(int((1 - KEEP_SHARE) * n_good)).first()["score"])
    return trees


def describe(docs: DataFrame, trees: Trees | None = None) -> DataFrame:
    """Per row of ``doc_id, text``: the counts of the base rules, ``features`` and the trees' ``score`` (1 without trees).

    A null text has no words. Repeated rows each get their result, an empty table gives an empty table, other columns
    are ignored.
    """
    schema = docs.schema["doc_id"].dataType
    arrow = to_arrow_type(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 512):
            if not len(batch):
                continue
            counts, features = zip(*map(statistics, (t.as_py() for t in batch["text"])), strict=True)
            x = np.array(features)
            score = np.ones(len(x)) if trees is None else trees.scores(x)
            columns = [pa.array(c, pa.int64()) for c in zip(*counts, strict=True)]
            listed = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype="i4") * x.shape[1], x.ravel())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].cast(arrow), *columns, listed, pa.array(score)],
                ["doc_id", *COUNTS, "features", "score"],
            )

    counts = ", ".join(f"{c} long" for c in COUNTS)
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {schema.simpleString()}, {counts}, features array<double>, score double"
    )


def judge(docs: DataFrame, trees: Trees | None) -> DataFrame:
    """``describe`` with ``base_failed`` and ``kept``: the base rules passed, and the score at least the threshold."""
    failed = _base_failed("n_words", "n_repeat_words")
    threshold = 0.0 if trees is None else trees.threshold
    return describe(docs, trees).withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    judged = judge(docs, fit(docs, read(spark, sf_dir, "labels")))
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", "score")
