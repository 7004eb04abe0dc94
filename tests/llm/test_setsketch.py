import numpy as np
import pytest

from chronolink.llm import setsketch
from chronolink.llm.components import components


def sets_of(texts):
    out = {}
    for key, text in texts.items():
        words = (text or "").encode().lower().split()
        size = min(5, len(words))
        out[key] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if words else set()
    return out


def brute(texts):
    """(size, smallest id reachable) of every text."""
    sets, parent = sets_of(texts), {k: k for k in texts}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(texts)
    for n, a in enumerate(keys):
        for b in keys[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {k: (len(sets[k]), find(k)) for k in texts}


def run(df):
    rows = setsketch.near_duplicates(df).collect()
    assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in rows)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}


def changed(rng, words, count):
    words = list(words)
    for k in rng.choice(len(words), count, replace=False):
        words[k] = f"n{rng.integers(1 << 30)}"
    return words


def test_groups_chains_and_copies(table):
    rng = np.random.default_rng(1)
    texts, key = {}, 0
    for base in range(6):
        words = [f"w{base}_{rng.integers(1000)}" for _ in range(200)]
        for k in range(12):
            texts[key] = " ".join(changed(rng, words, int(rng.integers(0, 9))))
            key += 1
        for _ in range(5):  # a chain: each close to the one before
            words = changed(rng, words, 4)
            texts[key] = "\t".join(words).upper()
            key += 1
        texts[key] = texts[key - 3].lower()
        key += 1
    texts |= {1000: None, 1001: "", 1002: " \n ", 1003: "one two", 1004: "ONE\ntwo", 1005: "one two three", 1006: "É a", 1007: "é a"}
    got = run(table([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, digest string"))
    assert got == brute(texts)


def test_shared_passages_do_not_link(table, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 4)
    rng = np.random.default_rng(2)
    passage = [f"p{k}" for k in range(60)]
    texts = {k: " ".join([*passage, *(f"x{rng.integers(1 << 40)}" for _ in range(22 if k % 3 else 12))]) for k in range(60)}
    texts |= {100 + k: " ".join([*passage, *(f"y{k // 4}_{n}" for n in range(22)), f"z{k}"]) for k in range(16)}
    assert run(table(list(texts.items()), "doc_id long, text string")) == brute(texts)


def test_repeated_rows_and_empty_table(table):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (2, text), (3, "q"), (3, "q")]
    got = setsketch.near_duplicates(table(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == [
        (1, 4, 1), (1, 4, 1), (2, 4, 1), (3, 1, 3), (3, 1, 3)
    ]
    assert run(table([], "doc_id long, text string")) == {}
    kept = setsketch.without_near_duplicates(table([(*r, 0) for r in rows], "doc_id long, text string, _gone int"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 3, 3]


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = x[:2000], x[500:2500]
    assert (setsketch.merge(setsketch.sketch(a), setsketch.sketch(b)) == setsketch.sketch(x[:2500])).all()
    got = [
        setsketch.estimate(
            np.array([(p > q).sum()]), np.array([(p < q).sum()]), np.array([len(a)]), np.array([len(b)])
        )[0]
        for p, q in [(setsketch.sketch(a), setsketch.sketch(b))]
    ]
    assert abs(got[0] - 1500 / 2500) < 0.15


@pytest.mark.parametrize("seed", range(3))
def test_components(table, seed):
    rng = np.random.default_rng(seed)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(k, k + 1) for k in range(200, 260)]
    edges += [(300, k) for k in range(301, 340)] + [(400, 400)]
    parent = {}

    def find(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    got = {r["node"]: r["component"] for r in components(table(edges, "a long, b long")).collect()}
    assert got == {k: find(k) for k in parent}
    if seed == 0:
        assert components(table([], "a long, b long")).count() == 0


def test_whole_table(spark, texts):
    rows = setsketch.op5_near_duplicates(spark, "/root/testdata/sf0.001").collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == brute(texts)
