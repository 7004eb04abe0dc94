import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from chronolink.llm import bpe


@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path(bpe.RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def rows_of(df):
    return sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in df.collect())


HARD = [
    "don't 'll we'll   x \n\n  y\t\tz" * 40,
    "a" * 900 + " b" * 300,
    " " * 700 + "x" + "\n" * 500,
    "é漢字😀 " * 200,
    "'s" * 600,
    "12345 " * 150 + "<|endoftext|>",
    "",
    "x",
]


def test_chunks_give_the_ids_of_the_whole(table, encoding):
    rows = [*enumerate(HARD), (100, None), (0, HARD[0]), (0, HARD[0]), (None, HARD[3])]
    df = bpe.encode(table(rows, "doc_id long, text string"), chunk=100, overlap=30)
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in df.collect()]
    want = [(k, encoding.encode_ordinary(t or "")) for k, t in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    back = bpe.decode(df).collect()
    assert sorted(bytes(r["bytes"]) for r in back) == sorted((t or "").encode() for _, t in rows)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1 \n\t'sl.é \x1c!", max_size=300), st.integers(8, 40))
def test_stitched_chunks(encoding, text, chunk):
    overlap = min(8, chunk)
    count = max(1, len(text) // chunk)
    parts = []
    for no in range(count):
        left, last = min(overlap, no * chunk), no + 1 == count
        end = len(text) if last else (no + 1) * chunk + overlap
        parts.append(bpe.encode_chunk(bpe.Vocabulary(), text[no * chunk - left : end], left, chunk, last, overlap))
    if None not in parts:
        assert np.frombuffer(b"".join(parts), "<u4").tolist() == encoding.encode_ordinary(text)


def test_whole_table(spark, texts, encoding):
    rows = bpe.op2_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = np.array(encoding.encode_ordinary(texts[r["doc_id"]]), "<u4")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_empty_table_and_clashing_columns(table):
    assert bpe.digests(table([], "doc_id long, text string")).count() == 0
    df = bpe.digests(table([(1, "x", 3, "y")], "doc_id long, text string, ids int, _id string"))
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert df.count() == 1
