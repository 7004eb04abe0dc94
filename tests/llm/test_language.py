import math
import re
import zlib
from collections import Counter

import pytest

from chronolink.llm import language

LANGS = {
    "en": "the cat and the dog went to the house of the king",
    "fr": "le chat et le chien sont dans la maison du roi",
    "de": "der hund und die katze sind in dem haus des königs",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(text, lang) for lang, text in LANGS.items() for _ in range(5)] + [(None, "en"), ("x", None)]
    return language.fit(spark.createDataFrame(rows, "text string, lang string"))


def predict(df, model, **options):
    return {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(df, model, **options).collect()}


def test_words_and_backoff(table, model):
    rows = [(1, "the king and the dog"), (2, "die könige"), (3, "chiens maisons"), (4, "12 $% --"), (5, None), (6, "")]
    got = predict(table(rows, "doc_id long, text string"), model)
    assert [got[k][0] for k in range(1, 7)] == ["en", "de", "fr", "und", "und", "und"]
    assert got[4][1] == got[5][1] == 0.0
    assert all(0 < got[k][1] <= 1 for k in (1, 2, 3))


def test_known_words_have_their_frequencies(model):
    assert model.languages == ["de", "en", "fr"]
    scores = model.word("the")
    assert scores[1] == max(scores)
    assert model.words["the"] == scores
    assert "unseenword" not in model.words


def test_backoff_falls_to_single_characters(model):
    assert model.word("zzkz") != (0.0,) * 3  # k is known
    assert model.word("漢") == (0.0,) * 3


def test_clashing_columns_and_repeated_rows(table, model):
    rows = [(1, "the dog", "x", 5), (1, "the dog", "x", 5)]
    df = language.identify(table(rows, "doc_id long, text string, score string, _text int"), model)
    assert sorted(df.columns) == ["_text", "doc_id", "lang_pred", "score", "text"]
    assert [r["lang_pred"] for r in df.collect()] == ["en", "en"]


def test_nothing_to_learn_from(table):
    empty = table([], "text string, lang string")
    nothing = language.fit(empty)
    got = predict(table([(1, "the dog")], "doc_id long, text string"), nothing)
    assert got == {1: ("und", 0.0)}
    assert language.identify(table([], "doc_id long, text string"), nothing).count() == 0


def test_long_texts_are_read_to_the_end(model):
    text = "the " * 400_000 + "le " * 2_000_000
    words = [w for part in language.words_of(text) for w in part]
    assert len(words) == 2_400_000
    assert language._Scores(model).predict(text)[0] == "fr"


def test_held_out_accuracy(spark):
    rows = language.op1_language(spark, "/root/testdata/sf0.001").collect()
    langs = {
        r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    }
    assert len(rows) == len(langs)
    held = [r for r in rows if r["held_out"]]
    assert 0.1 < len(held) / len(rows) < 0.3
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_accepted_keeps_columns_and_clean_rows(table):
    rows = [(k, LANGS["en"], "en", "s") for k in range(10)] + [(10, "123", "en", "s"), (11, None, None, "s")]
    kept = language.accepted(table(rows, "doc_id long, text string, lang string, score string"))
    assert kept.columns == ["doc_id", "text", "lang", "score"]
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(10))


def test_rare_languages_are_learned(table):
    rows = [(LANGS["en"], "en")] * 4000 + [("кот и собака живут в доме короля", "ru"), ("katten och hunden bor i huset", "sv")]
    rare = language.fit(table([*rows, ("12 34", "xx")], "text string, lang string"))
    assert rare.languages == ["en", "ru", "sv"]
    texts = [(1, "собака короля"), (2, "hunden och katten"), (3, "the king and katten"), (4, "a new queen of houses")]
    got = predict(table(texts, "doc_id long, text string"), rare)
    assert [got[k][0] for k in (1, 2, 3, 4)] == ["ru", "sv", "en", "en"]


def test_accepted_on_skewed_mixes(table):
    letters = ["αβγ", "где", "גדה", "กขค", "ઉઊઋ", "ကခဂ"]  # one language each
    rows = [(k, "the cat and the dog", "en") for k in range(3000)] + [(9000 + k, t, f"l{k}") for k, t in enumerate(letters)]
    docs = table([*rows, (9999, "漢字", None)], "doc_id long, text string, lang string")
    assert {r["doc_id"] for r in language.accepted(docs).collect()} == {r[0] for r in rows}
    unlabelled = table([(1, "the dog", None), (2, "12", None), (3, None, None)], "doc_id long, text string, lang string")
    assert [r["doc_id"] for r in language.accepted(unlabelled).collect()] == [1]


def test_memory_of_words_may_run_full(model, monkeypatch):
    texts = [f"the king word{k} of{k} " * 3 + " ".join(f"w{chr(97 + k)}{chr(97 + n)}" for n in range(26)) for k in range(26)]
    texts = [re.sub("[0-9]+", lambda m: "abcdefghij"[int(m[0]) % 10], t) for t in texts]
    want = [language._Scores(model).predict(t) for t in texts]
    monkeypatch.setattr(language, "REMEMBERED", 40)
    scores = language._Scores(model)
    assert [scores.predict(t) for t in texts] == want


def brute(rows, learned):
    """lang_pred and score of each (id, text) from (lang, text) rows, in plain Python by the docstring of the module."""
    words, grams = {}, {}
    for lang, text in learned:
        for word in re.findall(r"[^\W\d_]+", text.lower()):
            words.setdefault(lang, Counter())[word] += 1
    for lang, own in words.items():
        for word, n in own.items():
            for size in (5, 4, 3, 2, 1):
                marked = word if size == 1 else f" {word} "
                for k in range(len(marked) - size + 1):
                    grams.setdefault(size, {}).setdefault(lang, Counter())[marked[k : k + size]] += n
    langs = sorted(words)

    def entries(counts, share):
        sums = {lang: sum(own.values()) for lang, own in counts.items()}
        kept = {e for lang, own in counts.items() for e, n in own.items() if n >= sums[lang] * share}
        return {
            e: [math.log(max(counts.get(g, {}).get(e, 0) / (sums.get(g, 0) + 1.0), 1e-2 * share)) for g in langs] for e in kept
        }

    known, tables = entries(words, 2e-5), {size: entries(own, 5e-5) for size, own in grams.items()}
    out = {}
    for doc_id, text in rows:
        total, n = [0.0] * len(langs), 0
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            n += 1
            scores = known.get(word)
            for step, size in enumerate((5, 4, 3, 2, 1), 1):
                if scores is not None:
                    break
                marked = word if size == 1 else f" {word} "
                parts = [marked[k : k + size] for k in range(len(marked) - size + 1)]
                found = [tables[size][p] for p in parts if p in tables.get(size, {})]
                if found:
                    scores = [0.7**step * sum(x) / len(found) for x in zip(*found)]
            total = [t + s for t, s in zip(total, scores or [0.0] * len(langs))]
        if not n:
            out[doc_id] = ("und", 0.0)
            continue
        odds = [math.exp((t - max(total)) / math.sqrt(n)) for t in total]
        out[doc_id] = (langs[odds.index(max(odds))], max(odds) / sum(odds))
    return out


def test_scores_of_the_query_against_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {d: zlib.crc32(str(d).encode()) % 5 == 0 for d, _, _ in docs}
    want = brute([(d, t) for d, t, _ in docs], [(lang, t) for d, t, lang in docs if t and lang and not held[d]])
    got = {r["doc_id"]: r for r in language.op1_language(spark, path).collect()}
    assert got.keys() == want.keys()
    for doc_id, (lang, score) in want.items():
        assert (got[doc_id]["lang_pred"], got[doc_id]["held_out"]) == (lang, held[doc_id])
        assert got[doc_id]["score"] == pytest.approx(score, abs=1e-9)
