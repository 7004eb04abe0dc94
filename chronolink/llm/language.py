"""Language of whole texts: known words first, then ever shorter character n-grams.

Learning counts the words of all labelled training texts in Spark, and from the counted words the character
n-grams of each length. A word is known if it makes up ``WORD_SHARE`` of the words of some language, an n-gram
if it makes up ``GRAM_SHARE`` of the n-grams of its length. So a language has 1 / share entries at most, whatever
the size of the corpus, and the model is small enough to go to every task. Every language that labels a text with a word
is learned, however few texts it has. What a language does not have counts the same in each, as a part of the
share, so that one with few words gains nothing from words it has never seen.

A known word adds its log frequencies. For an unseen word the longest n-grams that are known decide, and each
step down counts less.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronolink.functions.once import with_columns_once
from chronolink.plans.staging import stage

from .tables import read, small

UNKNOWN = "und"
WORD_SHARE = 2e-5
GRAM_SHARE = 5e-5
#: Part of the share that an entry has in a language without it.
UNSEEN = 1e-2
GRAMS = (5, 4, 3, 2, 1)
#: Weight of each step to shorter n-grams.
BACKOFF = 0.7
#: Documents of one fold in so many are held out of learning.
FOLDS = 5

#: Characters looked at together, counts held before they are passed on, word scores remembered by a worker.
SPAN = 1 << 20
HELD = 100_000
REMEMBERED = 150_000

_WORD = re.compile(r"[^\W\d_]+")
_GAP = re.compile(r"[\W\d_]")


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-cased words, a stretch of text at a time."""
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + SPAN) if len(text) - at > SPAN else None
        end = cut.start() if cut else len(text)
        yield _WORD.findall(text[at:end].lower())
        at = end


def held_out(id: str = "doc_id") -> Column:
    """Whether a document is held out of learning."""
    return F.crc32(F.col(id).cast("string").cast("binary")) % FOLDS == 0


def _counted(name: str, counts: dict[str, Counter[str]]) -> Iterator[pa.RecordBatch]:
    """Pass the counts on and forget them."""
    for lang, own in counts.items():
        if own:
            arrays = [pa.array([lang] * len(own)), pa.array(list(own)), pa.array(list(own.values()), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", name, "n"])
    counts.clear()


def _count_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter[str]] = {}
    for batch in small(batches):
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            own = counts.setdefault(lang, Counter())
            for words in words_of(text):
                own.update(words)
        if sum(map(len, counts.values())) > HELD:
            yield from _counted("word", counts)
    yield from _counted("word", counts)


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter[str]] = {}
    for batch in small(batches, 1024):
        for lang, word, n in zip(*(batch[c].to_pylist() for c in ("lang", "word", "n")), strict=True):
            own = counts.setdefault(lang, Counter())
            grams = [gram for size in GRAMS for gram in grams_of(word, size)]
            if n == 1:
                own.update(grams)
            else:
                for gram in grams:
                    own[gram] += n
        if sum(map(len, counts.values())) > HELD:
            yield from _counted("gram", counts)
    yield from _counted("gram", counts)


def grams_of(word: str, size: int) -> list[str]:
    """N-grams of a word with its ends marked; single characters without marks."""
    marked = f" {word} " if size > 1 else word
    return [marked[k : k + size] for k in range(len(marked) - size + 1)]


class Model:
    """Log frequencies per language of words and n-grams."""

    def __init__(self, languages, words, grams):
        self.languages: list[str] = languages
        self.words: dict[str, tuple[float, ...]] = words
        self.grams: dict[str, tuple[float, ...]] = grams

    def word(self, word: str) -> tuple[float, ...]:
        """Log frequencies of a word, or what its longest known n-grams say."""
        if (known := self.words.get(word)) is not None:
            return known
        weight = 1.0
        for size in GRAMS:
            weight *= BACKOFF
            found = [g for g in map(self.grams.get, grams_of(word, size)) if g is not None]
            if found:
                part = weight / len(found)
                return tuple([part * sum(x) for x in zip(*found, strict=True)])
        return (0.0,) * len(self.languages)

    def accepts(self, text: str | None) -> bool:
        """Whether a text has a letter, and a word or n-gram of some language if any was learned.

        The first such words decide, so little of a text is looked at and nothing is remembered.
        """
        letter, known = False, not self.languages
        for words in words_of(text or ""):
            for word in words:
                letter = letter or any(c.isalpha() for c in word)
                known = known or word in self.words or any(g in self.grams for size in GRAMS for g in grams_of(word, size))
                if letter and known:
                    return True
        return False


class _Scores(dict):
    """Row of each word in a growing matrix of scores."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.rows = model, np.empty((1 << 12, len(model.languages)))

    def __missing__(self, word: str) -> int:
        k = self[word] = len(self)
        if k == len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[k] = self.model.word(word)
        return k

    def _sums(self, text: str | None) -> tuple[np.ndarray, int, bool]:
        """Log frequencies of all words per language, the number of words, and whether there is a letter."""
        total, count, letter = np.zeros(len(self.model.languages)), 0, False
        for words in words_of(text or ""):
            if not words:
                continue
            letter = letter or any(c.isalpha() for w in words for c in w)
            if len(self) > REMEMBERED:
                self.clear()
            rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
            total += self.rows[rows].sum(0)
            count += len(words)
        return total, count, letter

    def predict(self, text: str | None) -> tuple[str, float]:
        total, count, letter = self._sums(text)
        if not letter or not len(total):
            return UNKNOWN, 0.0
        # Words of a text hang together: its evidence grows as the root of their number.
        scaled = (total - total.max()) / math.sqrt(count)
        odds = np.exp(scaled)
        best = int(scaled.argmax())
        return self.model.languages[best], float(odds[best] / odds.sum())


def fit(docs: DataFrame, *, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows that have a text and a label; without any, no language is known."""
    labelled = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna()
    words = stage(
        labelled.mapInArrow(_count_words, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "language-words",
    )
    languages = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    if not languages:
        return Model([], {}, {})
    grams = (
        words.mapInArrow(_count_grams, "lang string, gram string, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("size", F.length("gram"))
    )
    grams = stage(grams, "language-grams")
    return Model(
        languages,
        _table(words.withColumn("size", F.lit(0)), "word", WORD_SHARE, languages),
        _table(grams, "gram", GRAM_SHARE, languages),
    )


def _table(counts: DataFrame, key: str, share: float, languages: list[str]) -> dict[str, tuple[float, ...]]:
    """Log frequencies of the entries that have their share: 1 / share per language and size at most."""
    sums = {(r["lang"], r["size"]): r["n"] for r in counts.groupBy("lang", "size").agg(F.sum("n").alias("n")).collect()}
    if not sums:
        return {}
    spark = counts.sparkSession
    least = spark.createDataFrame([(*k, n * share) for k, n in sums.items()], "lang string, size int, least double")
    frequent = (
        counts.join(F.broadcast(least), ["lang", "size"])  # a row per language and length
        .filter(F.col("n") >= F.col("least"))
        .select(key)
        .distinct()
    )
    kept = counts.join(frequent, key, "left_semi").select(key, "size", "lang", "n")
    seen: dict[str, dict[str, int]] = {}
    sizes: dict[str, int] = {}
    for entry, size, lang, n in kept.collect():
        seen.setdefault(entry, {})[lang] = n
        sizes[entry] = size
    return {
        entry: tuple(
            math.log(max(by.get(lang, 0) / (sums.get((lang, sizes[entry]), 0) + 1.0), UNSEEN * share))
            for lang in languages
        )
        for entry, by in seen.items()
    }


def identify(docs: DataFrame, model: Model, *, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (0 to 1) from the text alone; columns of these names are replaced.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text if no language was
    learned. Of languages with equal scores the first in order is taken. Rows are kept as they are, repeated
    ones too. ``keep`` names the columns to return, all unless given.
    """
    spark = docs.sparkSession
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    sent = spark.sparkContext.broadcast(model)
    # A text that is returned is sent once; one that is not goes in front.
    beside, at = text not in kept, kept.index(text) if text in kept else 0

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = _scores(sent)
        for batch in small(batches):
            found = [scores.predict(t) for t in batch.column(0 if beside else at).to_pylist()]
            arrays = batch.columns[1:] if beside else batch.columns
            arrays += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "lang_pred", "score"])

    schema = docs.select(*kept, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return docs.select(*[F.col(c) for c in ([text] if beside else []) + kept]).mapInArrow(run, schema)


_LAST: list = [None, None]


def _scores(sent) -> _Scores:
    """The worker's memory of word scores, as long as the model stays the same."""
    model = sent.value
    if _LAST[0] is not model:
        _LAST[:] = [model, _Scores(model)]
    return _LAST[1]


def accepted(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """Documents with a letter, and with a word or n-gram of a known language if there is any; with their own columns.

    All labelled documents are learned from, as nothing is measured here: one held out may be the only one of its language.
    Only texts go to Python and only verdicts come back; the rows wait for them in the JVM.
    """
    model = fit(docs, text=text)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def judge(texts: pa.Array) -> pa.Array:
        model, sure = sent.value, []
        for at in range(0, len(texts), 256):
            sure += [model.accepts(t) for t in texts.slice(at, 256).to_pylist()]
        return pa.array(sure, pa.bool_())

    names = {c: f"_c{n}" for n, c in enumerate(docs.columns)}  # clear of the column that is added
    named = docs.select(*[F.col(c).alias(n) for c, n in names.items()])
    judged = with_columns_once(named, {"sure": F.arrow_udf(judge, "boolean")(F.col(names[text]))})
    return judged.filter("sure").select(*[F.col(n).alias(c) for c, n in names.items()])


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs.filter(~held_out()))
    marked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return identify(marked, model, keep=["doc_id", "held_out"])
