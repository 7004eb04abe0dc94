import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from chronolink.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, top=20):
    counts = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    queries = {}
    for item, text in items:
        queries.setdefault(item, Counter()).update(TERM.findall((text or "").translate(LOWER)))
    out = set()
    for item, query in queries.items():
        scores = []
        for doc, c in counts:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(
                k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, k in query.items()
                if t in c
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        ranked = sorted(scores)[:top]
        out |= {(item, n + 1, row[3], -row[0]) for n, row in enumerate(ranked)}
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ09é-_ \n@[`{\x7f\x85İ", max_size=20))
def test_terms(text):
    assert [t.decode() for t in search.terms(text)] == TERM.findall(text.translate(LOWER))


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 400), st.integers(1, 12))
def test_range_maxima(seed, n, n_terms):
    rng = np.random.default_rng(seed)
    lists = []
    for _ in range(n):
        which = rng.permutation(n_terms)[: rng.integers(1, n_terms + 1)]
        lists.append((which.astype(np.int32), rng.integers(0, 50, len(which))))
    segment = search.Segment(list(range(n)), lists, n_terms)
    low = rng.integers(0, n, 30)
    high = low + rng.integers(1, n + 1, 30).clip(max=n - low)
    terms = np.arange(n_terms)
    place, impact = segment.greatest(*segment.postings(terms, low, high))
    table = np.zeros((n, n_terms), int)
    for doc, (which, value) in enumerate(lists):
        table[doc, which] = value
    for k in range(30):
        assert (impact[k] == table[low[k] : high[k]].max(axis=0)).all()
        held = impact[k] > 0
        at = segment.keys[place[k][held]] % n
        assert (table[at, terms[held]] == impact[k][held]).all() and ((at >= low[k]) & (at < high[k])).all()


@pytest.fixture(params=[(32, 64), (1, 1), (4, 3)])
def sizes(request):
    held = search.LEAF, search.BATCH
    search.LEAF, search.BATCH = request.param
    yield
    search.LEAF, search.BATCH = held


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 2**32 - 1), n=st.integers(1, 600), top=st.integers(1, 5))
def test_a_segment_is_searched_exactly(sizes, seed, n, top):
    rng = np.random.default_rng(seed)
    lists = [(w := rng.permutation(9)[: rng.integers(1, 10)].astype(np.int32), rng.integers(0, 4, len(w))) for _ in range(n)]
    ids = sorted(rng.integers(0, n, n).tolist())
    times = rng.integers(1, 3, 4)
    best = search.Best(top, [])
    search.search_segment(search.Segment(ids, lists, 9), np.array([0, 3, 4, 8]), times, best)
    weights = dict(zip((0, 3, 4, 8), times.tolist()))
    scores = [sum(weights.get(t, 0) * v for t, v in zip(w.tolist(), val.tolist())) for w, val in lists]
    expected = sorted((-s, i) for s, i in zip(scores, ids) if s > 0)[:top]
    assert best.held == [(-s, i) for s, i in expected]


def rows_of(df):
    rows = [tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()]
    assert len(set(rows)) == len(rows)
    return set(rows)


def test_odd_rows(table):
    common = "alpha beta gamma"
    docs = [(n, f"{common} w{n % 7}") for n in range(300)]
    docs += [(n % 5 + 1000, "copied text of many rows") for n in range(60)]
    docs += [(None, "alpha only here"), (7777, None), (7778, ""), (7779, "... !!"), (7780, "zeta " * 400_000), (3, "ALPHA beta")]
    items = [(1, "alpha beta"), (2, "copied rows"), (3, None), (None, "Zeta"), (4, "w3"), (4, "w3 W5"), (5, "nowhere"), (6, "here")]
    df = table([(*d, 1, "x", 2) for d in docs], "doc_id long, text string, score int, item_id string, rank int")
    asked = table([(*i, 9) for i in items], "item_id long, text string, doc_id int")
    expected = brute(docs, items)
    assert rows_of(search.search(df, asked)) == expected
    assert rows_of(search.search(df, asked, block_terms=3)) == expected
    nothing = table([], "doc_id long, text string")
    assert search.search(nothing, asked).count() == 0
    assert search.search(df, table([], "item_id long, text string")).count() == 0


def test_query(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{path}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows_of(search.op11_lexical_search(spark, path)) == brute(docs, items)
