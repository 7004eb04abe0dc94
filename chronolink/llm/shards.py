"""Sharding by sampled splitters: shards of near equal bytes.

Records are ordered by (text hash, id hash), so equal texts stand together and yet a hot text can be cut.
A size-weighted sample of keys gives quantile splitters; they cut the records into ranges that are counted
exactly, and ranges that turn out overfull are cut again by a sample of their own. The position of a
record in bytes, exact over all ranges, gives its shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolink.plans.staging import stage

from .tables import read

SHARDS = 40
#: Bytes of every record beside its text.
RECORD_BYTES = 16
#: A range holds so many records at most by plan, and a shard is cut from at least so many ranges.
RANGE_ROWS = 500_000
RANGES_A_SHARD = 4
#: Expected sample size for each range; the driver holds no more than this times the ranges.
DRAWS = 24
#: A range with more than this times its planned bytes is cut again.
OVERFULL = 2.0

_KEYS = ["_k1", "_k2"]


def _draw(rows: DataFrame, expected: float, total: int, seed: int) -> list[tuple]:
    """Keys drawn in proportion to bytes, with the bytes that each stands for; in order."""
    chance = F.col("size") * (expected / total)
    weight = F.greatest(F.col("size").cast("double"), F.lit(total / expected))
    drawn = rows.filter(F.rand(seed) < chance).select(*_KEYS, weight.alias("w"))
    return sorted(tuple(r) for r in drawn.collect())


def _quantiles(sample: list[tuple], parts: int) -> list[tuple]:
    """At most ``parts`` - 1 splitters that cut the sample into parts of equal weight."""
    whole, done, found = sum(w for *_, w in sample), 0.0, []
    for k1, k2, w in sample:
        if done and int(done * parts / whole) != int((done + w) * parts / whole):
            found.append((k1, k2))
        done += w
    return found[: parts - 1]


def _range_of(bounds: list[tuple]) -> Column:
    """The number of splitters at or below the record's key."""
    if not bounds:
        return F.lit(0)
    text = ", ".join(f"named_struct('_k1', {a}L, '_k2', {b}L)" for a, b in bounds)
    return F.expr(f"size(filter(array({text}), b -> b <= named_struct('_k1', _k1, '_k2', _k2)))")


def assign(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per record: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``size`` is the bytes of the text plus 16; a null text has none and the checksum 0. Shard sizes differ
    from their mean by the largest record at most. ``slot`` counts from 0 without gaps inside a shard.
    Repeated rows are records of their own; an empty table gives an empty table; other columns are ignored.
    """
    raw = F.col(text).cast("binary")
    rows = stage(
        docs.select(
            F.col(id).alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_BYTES).cast("long").alias("size"),
            F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
            F.xxhash64(F.col(text)).alias("_k1"),
            F.xxhash64(F.col(id)).alias("_k2"),
        ),
        "shard-rows",
    )
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(shards * RANGES_A_SHARD, -(-count // RANGE_ROWS))
    bounds, stats = [], []
    if count:
        bounds = _quantiles(_draw(rows, parts * DRAWS, total, 11), parts)
        stats = _count(rows, bounds)
        for seed in (12, 13, 14):
            over = [s for s in stats if s["bytes"] > OVERFULL * total / parts and s["rows"] > 1]
            more = set()
            for s in over:
                part = rows.filter(_range_of(bounds) == s["_range"])
                cut = 1 + int(s["bytes"] * parts / total)
                more.update(_quantiles(_draw(part, cut * DRAWS, s["bytes"], seed), cut))
            if more <= set(bounds):
                break
            bounds = sorted(more | set(bounds))
            stats = _count(rows, bounds)

    # One number for each range; from here on the ranges are only read.
    sizes = {s["_range"]: (s["bytes"], s["rows"]) for s in stats}
    before_bytes, before_rows = [0], [0]
    for k in range(len(bounds)):
        b, r = sizes.get(k, (0, 0))
        before_bytes.append(before_bytes[-1] + b)
        before_rows.append(before_rows[-1] + r)
    inside = Window.partitionBy("_range").orderBy(*_KEYS, "doc_id")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("size").over(earlier), F.lit(0)) + _pick(before_bytes, F.col("_range"))
    middle = at.cast("double") + F.col("size") / 2
    placed = stage(
        rows.withColumn("_range", _range_of(bounds))
        .withColumn(
            "shard", F.least(F.floor(middle * shards / max(1, total)), F.lit(shards - 1)).cast("int")
        )
        .withColumn(
            "_row", F.row_number().over(inside) - 1 + _pick(before_rows, F.col("_range"))
        )
        .select("doc_id", "size", "text_crc32", "shard", "_row"),
        "shard-places",
    )
    first = dict(placed.groupBy("shard").agg(F.min("_row")).collect())  # one row per shard
    starts = [first.get(k, 0) for k in range(shards)]
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_row") - _pick(starts, F.col("shard"))).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _count(rows: DataFrame, bounds: list[tuple]) -> list:
    ranged = rows.select("size", _range_of(bounds).alias("_range"))
    return (
        ranged.groupBy("_range")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .collect()
    )


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(F.expr(f"array({', '.join(f'{v}L' for v in values)})"), index + 1)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents").select("doc_id", "text"))
