"""Benchmark decontamination by a broadcast set of normalised test n-grams.

A test item gives its windows of 13 words, or itself if it is shorter. Each window is known by the hash of its
words and by its longest word. A document is scanned once: only windows around a word that is the longest of some
test window are hashed, those whose hash is in the set are hits, and a hit counts if its words equal a test
window's. A test set of more than ``MAX_BROADCAST`` windows is not sent to the tasks: then all windows of the documents
meet it in a join on their words, with the same results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolink.plans.staging import stage

from .tables import ascii_lower, read, sql_strings

#: Words of a window.
WINDOW = 13
#: Windows that may be sent to every task.
MAX_BROADCAST = 200_000
#: A document is contaminated if one word in so many at least is hit.
HIT_SHARE = 20
#: What is no word after lower-casing A-Z.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_NO_INTS = "cast(array() as array<int>)"
_KEY = ["_id", "_text_hash"]


def words_of(text: Column) -> Column:
    """Lower-cased words of a text; none for null."""
    found = F.array_remove(F.split(ascii_lower(text), NO_WORD), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def windows(items: DataFrame, *, id: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Windows of the test items: ``words``, ``len``, ``hash``, ``anchor`` and the ``items`` that have them."""
    starts = F.expr(f"if(size(_w) = 0, {_NO_INTS}, sequence(0, greatest(size(_w) - {size}, 0)))")
    return (
        items.select(F.col(id).cast("string").alias("item"), words_of(F.col(text)).alias("_w"))
        .select("item", "_w", F.explode(starts).alias("_at"))
        .select("item", F.slice("_w", F.col("_at") + 1, size).alias("_g"))
        .select(
            "item",
            F.array_join("_g", " ").alias("words"),
            F.size("_g").alias("len"),
            F.xxhash64("_g").alias("hash"),
            F.expr("array_max(transform(_g, w -> struct(length(w), w))).w").alias("anchor"),
        )
        .groupBy("words", "len", "hash", "anchor")
        .agg(F.collect_set("item").alias("items"))
    )


def _near_anchors(length: int) -> str:
    """Starts of the windows of ``_w`` that have one of the positions ``_p``."""
    first, last = f"greatest(i - {length - 1}, 0)", f"least(i, size(_w) - {length})"
    around = f"transform(_p, i -> if({first} <= {last}, sequence({first}, {last}), {_NO_INTS}))"
    return f"array_distinct(flatten({around}))"


def _as_windows(starts: str, length: int) -> str:
    words = f"array_join(slice(_w, s + 1, {length}), ' ')"
    return f"transform({starts}, s -> named_struct('at', s, 'len', {length}, 'words', {words}))"


def _scan(docs: DataFrame, known: list) -> DataFrame:
    """Add ``_hits``, the windows whose hash is in the set ``known`` of rows (len, hash, anchor)."""
    if not known:
        none = "cast(array() as array<struct<at:int,len:int,words:string>>)"
        return docs.withColumn("_hits", F.expr(none))
    anchors = sql_strings(sorted({k["anchor"] for k in known}))
    at_anchor = f"filter(transform(_w, (w, i) -> if(w in ({anchors}), i, -1)), i -> i >= 0)"
    found = []
    for length in sorted({k["len"] for k in known}):
        hashes = ", ".join(f"'{k['hash']}'" for k in known if k["len"] == length)
        hit = f"cast(xxhash64(slice(_w, s + 1, {length})) as string) in ({hashes})"
        found.append(_as_windows(f"filter({_near_anchors(length)}, s -> {hit})", length))
    return docs.withColumn("_p", F.expr(at_anchor)).withColumn("_hits", F.expr(f"concat({', '.join(found)})")).drop("_p")


def _find(
    docs: DataFrame,
    items: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    max_broadcast: int = MAX_BROADCAST,
) -> tuple[DataFrame, DataFrame]:
    """``find`` in two tables: documents with their ``sets`` of items, and the items of every combination of sets.

    Windows that the same items have share a numbered set. A hit carries that number only, and what items a combination
    of sets comes to is worked out once, however many documents have it.
    """
    test = stage(windows(items, id=item_id, text=item_text, size=size), "test-windows")
    sets = stage(test.select("items").distinct().withColumn("set", F.monotonically_increasing_id()), "item-sets")
    numbered = test.join(sets, "items").select("words", "len", "set")
    plain = docs.select(
        F.col(id).alias("_id"), F.xxhash64(F.col(text)).alias("_text_hash"), words_of(F.col(text)).alias("_w")
    )
    if test.count() <= max_broadcast:
        known = test.select("len", "hash", "anchor").collect()  # max_broadcast rows at most
        scanned = stage(
            _scan(plain, known).select(*_KEY, F.size("_w").cast("long").alias("n_words"), "_hits"), "scanned"
        )
        hits = scanned.select(*_KEY, F.explode("_hits").alias("_hit"))
        numbered = F.broadcast(numbered)
    else:
        lengths = [r["len"] for r in test.select("len").distinct().collect()]  # `size` rows at most
        scanned = stage(plain.select(*_KEY, F.size("_w").cast("long").alias("n_words")), "scanned")
        starts = f"if(size(_w) >= {{0}}, sequence(0, size(_w) - {{0}}), {_NO_INTS})"
        every = ", ".join(_as_windows(starts.format(n), n) for n in lengths)
        hits = plain.select(*_KEY, F.explode(F.expr(f"concat({every})")).alias("_hit"))
    found = (
        hits.select(*_KEY, "_hit.*")
        .join(numbered, ["words", "len"])
        .groupBy(*_KEY)
        .agg(F.collect_set(F.struct("at", "len")).alias("spans"), F.sort_array(F.collect_set("set")).alias("sets"))
        .withColumnsRenamed({"_id": "_id2", "_text_hash": "_hash2"})
    )
    hit_words = "size(array_distinct(flatten(transform(spans, s -> sequence(s.at, s.at + s.len - 1)))))"
    joined = scanned.join(
        found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_text_hash") == F.col("_hash2")), "left"
    )
    n_hit = F.when(F.col("spans").isNull(), 0).otherwise(F.expr(hit_words)).cast("long")
    judged = joined.select(
        F.col("_id").alias(id),
        "_text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("sets", F.array().cast("array<bigint>")).alias("sets"),
        F.coalesce("spans", F.array().cast("array<struct<at:int,len:int>>")).alias("spans"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words")))
    judged = stage(judged, "judged-documents")
    members = sets.select("set", F.explode("items").alias("item"))
    combinations = (
        judged.select("sets")
        .distinct()
        .select("sets", F.explode("sets").alias("set"))
        .join(members, "set")
        .groupBy("sets")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
        .withColumnRenamed("sets", "_sets")
    )
    return judged, stage(combinations, "item-combinations")


_NO_ITEMS = "cast(array() as array<string>)"


def find(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Per document: ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted as strings), ``spans``, ``contaminated``.

    ``spans`` are stretches (start, length) in words, as they were found. A null or empty text has no words
    and is clean; items without words have no windows. Words of an item with a null id are hits, but it is neither
    counted nor listed. Repeated rows each get their result. An empty table gives an empty table, and without test items
    every document is clean. Other columns are ignored.
    """
    judged, combinations = _find(docs, items, **options)
    listed = judged.join(combinations, F.col("sets") == F.col("_sets"), "left").withColumn(
        "items", F.expr(f"coalesce(items, {_NO_ITEMS})")
    )
    return listed.select(
        judged.columns[0],
        "_text_hash",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        "spans",
        "contaminated",
    )


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    id, text = options.get("id", "doc_id"), options.get("text", "text")
    bad = _find(docs, items, **options)[0].filter("contaminated")
    bad = bad.select(F.col(id).alias("_id"), "_text_hash").distinct()
    same = docs[id].eqNullSafe(bad["_id"]) & (F.xxhash64(docs[text]) == bad["_text_hash"])
    return docs.join(bad, same, "left_anti")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, combinations = _find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    # The list of a combination is digested once; documents get the digest.
    digests = combinations.select(
        "_sets",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
    )
    return judged.join(digests, F.col("sets") == F.col("_sets"), "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        "contaminated",
    )


_WORDS = (
    r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
)
ORACLE = f"""
with doc as (select doc_id, {_WORDS} as w from documents),
item as (select item_id, {_WORDS} as w from benchmark),
test as (
  select distinct cast(item_id as varchar) as item, len(w[s + 1 : s + {WINDOW}]) as n,
    array_to_string(w[s + 1 : s + {WINDOW}], ' ') as words
  from item, unnest(range(0, greatest(len(w) - {WINDOW}, 0) + 1)) as t(s) where len(w) > 0),
sizes as (select distinct n from test),
seen as (
  select doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') as words
  from doc, sizes, unnest(range(0, len(w) - n + 1)) as t(s) where len(w) >= n),
hit as (select doc_id, s, seen.n, item from seen join test on seen.words = test.words and seen.n = test.n),
hit_words as (
  select doc_id, count(distinct p) as n_hit from hit, unnest(range(s, s + n)) as t(p) group by doc_id),
hit_items as (
  select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
  from hit group by doc_id)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and {HIT_SHARE} * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join hit_words using (doc_id) left join hit_items using (doc_id)
"""
