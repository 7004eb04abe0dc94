"""Ranked lexical search: intervals of documents bounded by range maxima of posting lists.

The corpus is read once: a document becomes its length and, for every term that a query has, how often it has it. From this
table come the counts that weigh a term. Tasks then take documents in segments. In a segment each term has a posting list of
(document, impact) with a sparse table for the place of the greatest impact in any range. For a query, an interval of
documents is bounded by the sum of its terms' range maxima. The best intervals are taken first: the document of the
greatest impact in the interval is scored and splits it in two, until no interval can still enter the best; short ones are
scored whole. A task keeps its best per query over all its segments, and the best of all tasks are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from chronolink.plans.staging import stage

from .tables import read, small

#: Documents returned per query.
TOP = 20
#: Terms of the queries that are searched together, as expected; more queries are searched in further blocks.
BLOCK_TERMS = 200_000
#: Documents and postings of a segment, at most (one document may have more postings).
SEGMENT_DOCS, SEGMENT_POSTINGS = 8192, 1 << 19
#: An interval of so many documents is scored whole.
LEAF = 32
#: Intervals that are taken together, the best ones.
BATCH = 64

# ASCII letters and digits and all other characters make terms; only A-Z is lower-cased.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8; none for null."""
    return (text or "").encode().translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a document's score."""
    return weights * (1_000_000_000 * tf // (1000 * tf + 12 * m))


class Segment:
    """Posting lists of some documents with a sparse table each, laid end to end.

    ``ids`` are the documents in order. A posting is keyed by term x documents + document, so ranges of all terms are found
    by one search. Level k of the table holds at each posting the place of the greatest impact among it and the 2^k - 1 that
    follow in its list, of equal ones the first.
    """

    def __init__(self, ids: list, lists: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        self.ids, self.size = ids, len(ids)
        owner = np.repeat(np.arange(self.size), [len(t) for t, _ in lists])
        keys = np.concatenate([t for t, _ in lists]).astype(np.int64) * self.size + owner
        order = np.argsort(keys)
        self.keys = keys[order]
        self.impact = np.concatenate([v for _, v in lists])[order]
        starts = np.searchsorted(self.keys, np.arange(n_terms + 1, dtype=np.int64) * self.size)
        ends = np.repeat(starts[1:], np.diff(starts))  # where the list of each posting ends
        place = np.arange(len(self.keys), dtype=np.int32)
        self.table, step = [place], 1
        longest = int(np.diff(starts).max(initial=0))
        while 2 * step <= longest:
            last = self.table[-1]
            after = np.minimum(place + step, len(place) - 1)
            other = np.where(place + step < ends, last[after], last)
            self.table.append(np.where(self.impact[other] > self.impact[last], other, last).astype(np.int32))
            step *= 2
        self.table = np.stack(self.table) if len(place) else np.zeros((1, 0), np.int32)

    def postings(self, terms: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First posting and the one after the last, per interval [low, high) and term."""
        base = terms[None, :] * self.size
        return np.searchsorted(self.keys, base + low[:, None]), np.searchsorted(self.keys, base + high[:, None])

    def greatest(self, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and impact of the greatest posting of each range; impact 0 where a range is empty."""
        length = end - first
        there = length > 0
        level = np.frexp(np.maximum(length, 1))[1] - 1
        at = np.where(there, first, 0)
        a = self.table[level, at]
        b = self.table[level, np.where(there, end - (1 << level), 0)]
        best = np.where(self.impact[b] > self.impact[a], b, a)
        return best, np.where(there, self.impact[best], 0)

    def score(self, terms: np.ndarray, times: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of single documents."""
        wanted = terms[None, :] * self.size + docs[:, None]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return (np.where(self.keys[at] == wanted, self.impact[at], 0) * times).sum(axis=1)

    def score_intervals(self, first, end, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of whole intervals that have a posting, with their scores; from the ranges of their postings."""
        lengths = (end - first).ravel()
        total = int(lengths.sum())
        run = np.repeat(np.cumsum(lengths) - lengths, lengths)
        at = np.repeat(first.ravel(), lengths) + np.arange(total) - run
        each = np.broadcast_to(times, first.shape).ravel()
        docs, where = np.unique(self.keys[at] % self.size, return_inverse=True)
        scores = np.zeros(len(docs), np.int64)
        np.add.at(scores, where, self.impact[at] * np.repeat(each, lengths))
        return docs, scores


@dataclass
class Best:
    """The best documents of a query so far, as (score, id), highest score and then least id first."""

    top: int
    held: list

    def add(self, scores: np.ndarray, ids: list, docs: np.ndarray) -> None:
        floor = self.held[-1][0] if len(self.held) == self.top else 1
        enough = scores >= floor
        new = [(s, ids[d]) for s, d in zip(scores[enough].tolist(), docs[enough].tolist(), strict=True)]
        if new:
            self.held = sorted(self.held + new, key=lambda h: (-h[0], _id_key(h[1])))[: self.top]

    def open(self, bounds: np.ndarray, low: np.ndarray, ids: list) -> np.ndarray:
        """Which intervals can still enter, by their bounds and, where these are equal to the last score, least ids."""
        if len(self.held) < self.top:
            return bounds > 0
        score, last = self.held[-1]
        can = bounds > score
        for k in np.flatnonzero(bounds == score):
            can[k] = _id_key(ids[low[k]]) < _id_key(last)
        return can


def _id_key(doc_id) -> tuple:
    return (doc_id is None, 0 if doc_id is None else doc_id)


def search_segment(segment: Segment, terms: np.ndarray, times: np.ndarray, best: Best) -> None:
    """Put the documents of a segment that belong there into ``best``; ``times`` is how often the query has each term."""

    def bound(low, high):
        """Greatest possible score of each interval, and the document of its greatest single impact."""
        place, impact = segment.greatest(*segment.postings(terms, low, high))
        impact = impact * times
        split = segment.keys[place[np.arange(len(low)), impact.argmax(axis=1)]] % segment.size
        return impact.sum(axis=1), split

    low, high = np.array([0]), np.array([segment.size])
    bounds, splits = bound(low, high)
    while True:
        can = best.open(bounds, low, segment.ids)
        order = np.flatnonzero(can)[np.argsort(-bounds[can], kind="stable")]
        if not len(order):
            return
        now, later = order[:BATCH], order[BATCH:]
        short = high[now] - low[now] <= LEAF
        whole, cut = now[short], now[~short]
        if len(whole):
            first, end = segment.postings(terms, low[whole], high[whole])
            docs, scores = segment.score_intervals(first, end, times)
            best.add(scores, segment.ids, docs)
        middle = splits[cut]
        best.add(segment.score(terms, times, middle), segment.ids, middle)
        new_low, new_high = np.concatenate([low[cut], middle + 1]), np.concatenate([middle, high[cut]])
        filled = new_low < new_high
        new_low, new_high = new_low[filled], new_high[filled]
        new_bounds, new_splits = bound(new_low, new_high)
        low, high = np.concatenate([low[later], new_low]), np.concatenate([high[later], new_high])
        bounds, splits = np.concatenate([bounds[later], new_bounds]), np.concatenate([splits[later], new_splits])


@dataclass
class Query:
    item: object
    terms: np.ndarray
    times: np.ndarray


def _count_terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches, 64):
        for item, text in zip(batch["item_id"], batch["text"].to_pylist(), strict=True):
            counts = Counter(terms(text))
            if counts:
                items = pa.array([item.as_py()] * len(counts), batch["item_id"].type)
                columns = [items, pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "term", "times"])


def query_terms(queries: DataFrame) -> DataFrame:
    """``(item_id, term, times)`` of queries ``(item_id, text)``; rows that share an id are one query."""
    kind = queries.schema["item_id"].dataType.simpleString()
    counted = queries.select("item_id", "text").mapInArrow(_count_terms, f"item_id {kind}, term binary, times long")
    return counted.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``(doc_id, n, terms, tfs)``: terms in all and, of the vocabulary, which and how often. Documents without terms are left out."""
    kind = docs.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                words = terms(text.as_py())
                if words:
                    found = Counter(vocabulary[w] for w in words if w in vocabulary)
                    rows.append((doc_id, len(words), list(found), list(found.values())))
            if rows:
                types = [arrow, pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
                columns = [pa.array(c, t) for c, t in zip(map(list, zip(*rows, strict=True)), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "terms", "tfs"])

    schema = f"doc_id {kind.simpleString()}, n long, terms array<int>, tfs array<int>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _segments(batches: Iterable[pa.RecordBatch], weights: np.ndarray, n_docs: int, n_terms: int) -> Iterator[Segment]:
    """Documents with postings in lots, each in order of its ids."""
    rows: list = []
    held = 0

    def close() -> Segment:
        rows.sort(key=lambda r: _id_key(r[0]))
        return Segment([r[0] for r in rows], [r[1:] for r in rows], len(weights))

    for batch in small(batches, 1024):
        m = 75 + 25 * batch["n"].to_numpy() * n_docs // n_terms
        lists = [batch[c].flatten().to_numpy() for c in ("terms", "tfs")]
        ends = np.cumsum(batch["terms"].value_lengths().to_numpy())
        for doc_id, end, length, own in zip(batch["doc_id"].to_pylist(), ends, np.diff(ends, prepend=0), m, strict=True):
            if not length:
                continue
            which, tf = (part[end - length : end] for part in lists)
            rows.append((doc_id, which, impacts(weights[which], tf.astype(np.int64), own)))
            held += int(length)
            if len(rows) >= SEGMENT_DOCS or held >= SEGMENT_POSTINGS:
                yield close()
                rows, held = [], 0
    if rows:
        yield close()


def _search_block(indexed: DataFrame, queries: list[Query], n_vocabulary: int, item_kind, top: int) -> DataFrame:
    n_docs, n_terms = indexed.agg(F.count("*"), F.sum("n")).first()
    df = np.zeros(n_vocabulary, np.int64)
    for term, count in indexed.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # vocabulary rows
        df[term] = count
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    doc_kind = indexed.schema["doc_id"].dataType
    types = [to_arrow_type(item_kind), to_arrow_type(doc_kind), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top, []) for _ in queries]
        for segment in _segments(batches, weights, n_docs, n_terms):
            for query, own in zip(queries, best, strict=True):
                search_segment(segment, query.terms, query.times, own)
        rows = [(q.item, doc_id, score) for q, own in zip(queries, best, strict=True) for score, doc_id in own.held]
        columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
        arrays = [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, ["item_id", "doc_id", "score"])

    schema = f"item_id {item_kind.simpleString()}, doc_id {doc_kind.simpleString()}, score long"
    # Spark keeps the first rows of each partition before it shuffles, so an item never gathers more than tasks x top.
    first = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = indexed.mapInArrow(run, schema).withColumn("rank", F.row_number().over(first))
    return ranked.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, queries: DataFrame, *, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``top`` documents with the highest positive scores for each query: ``item_id, rank, doc_id, score``.

    Equal scores go by ascending ``doc_id``, null last. A null or empty text has no terms: such a document does not count, such
    a query has no rows. Repeated document rows are documents of their own; rows that share an ``item_id``, null included,
    are one query with all their terms. Without documents or queries the result is empty; other columns are ignored.

    Queries are searched in blocks of about ``block_terms`` different (query, term) pairs. The driver holds one block.
    """
    counted = stage(query_terms(queries), "query-terms")
    spark = docs.sparkSession
    item_kind = counted.schema["item_id"].dataType
    blocks = -(-counted.count() // block_terms)
    found = spark.createDataFrame(
        [], f"item_id {item_kind.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long"
    )
    for block in range(blocks):
        rows = counted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        vocabulary: dict[bytes, int] = {}
        items: dict[object, list] = {}
        for item, term, times in rows:
            number = vocabulary.setdefault(bytes(term), len(vocabulary))
            items.setdefault(item, []).append((number, times))
        asked = [Query(i, *np.array(t, np.int64).T) for i, t in items.items()]
        indexed = stage(index(docs, vocabulary), "postings")
        found = found.unionByName(_search_block(indexed, asked, len(vocabulary), item_kind, top))
    return found


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
with doc as (select row_number() over () as r, doc_id, {_TERMS} as w from documents),
size as (select r, doc_id, len(w) as n from doc where len(w) > 0),
total as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from size),
asked as (select item_id, t, count(*) as times
  from (select item_id, unnest({_TERMS}) as t from benchmark) group by item_id, t),
posting as (select r, t, count(*) as tf from (select r, unnest(w) as t from doc)
  where t in (select t from asked) group by r, t),
weight as (select t, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from posting, total group by t, n_docs),
score as (
  select item_id, r, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) as bigint)
    as score
  from asked join posting using (t) join weight using (t) join size using (r), total group by item_id, r),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank
  from score join size using (r) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= {TOP}
"""
