import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from chronolink.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=70))
def test_packing_round_trip(bits, values):
    ids = np.array([v & ((1 << bits) - 1) for v in values], "<u4")
    raw = packing.pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    assert packing.unpack(raw, bits, len(ids)).tolist() == ids.tolist()


def test_random_access(tmp_path):
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 2**17, n, dtype=np.uint32) for n in (0, 5, 100, 33, 1)]
    path = str(tmp_path / "x.bin")
    packing._save(path, packing.file_bytes([1, 2, 3, 4, 5], docs, 17, 16))
    file, whole = packing.TokenFile(path), np.concatenate(docs)
    assert (file.bits, file.block, file.n_ids, file.n_docs) == (17, 16, 139, 5)
    assert file.keys.tolist() == [1, 2, 3, 4, 5]
    for start, stop in ((0, 139), (17, 90), (16, 32), (138, 139), (5, 5)):
        assert file.ids(start, stop).tolist() == whole[start:stop].tolist()
    assert [ids.tolist() for _, _, ids in file.documents()] == [d.tolist() for d in docs]
    (tmp_path / "y.bin").write_bytes(b"something else, of some length")
    with pytest.raises(ValueError, match="not a token file"):
        packing.TokenFile(str(tmp_path / "y.bin"))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab1 \n\t'sl.,é \x1c_²!", max_size=120))
def test_pieces_are_encoded_as_the_whole(tokenizer, text):
    got = packing.encoder(None).encode([text])[0]
    assert got.tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|>\n\nword, <|endoftext|", "x" * 2_000_000 + " <|endoftext|> y"])
def test_texts_with_added_tokens(tokenizer, text):
    assert packing.encoder(None).encode([text, "a b"])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert 50256 in packing.encoder(None).encode([text])[0] or not text.endswith("|>")


def test_many_words_at_once(tokenizer):
    text = " ".join(f"{chr(97 + n % 26) * (n % 5 + 1)}{'äéñ'[n % 3]}w{'Ġ' * (n % 2)}{n:x}".translate(str.maketrans("0123456789", "ghijklmnop")) for n in range(20_000))
    assert packing.Encoder(None).encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_text(tokenizer):
    text = "some words, and more of them.\n" * 80_000
    assert packing.encoder(None).encode([text])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_written_files(spark, table, tmp_path, tokenizer):
    rows = [(3, "three three"), (1, None), (2, ""), (2, ""), (None, "first"), (7, "<|endoftext|> x" * 50)]
    df = table([(*r, "u") for r in rows], "doc_id long, text string, ids string")
    files = packing.write(df, f"file://{tmp_path}/out", block=8, file_ids=3)
    got = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in packing.read_back(files).collect()]
    want, at = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        want.append((key, at, ids))
        at += len(ids)
    assert sorted(got, key=lambda r: r[1]) == want
    assert files.count() > 1
    assert packing.read_back(packing.write(table([], "doc_id long, text string"), f"{tmp_path}/none")).count() == 0


def test_whole_table(spark, texts, tokenizer):
    rows = sorted(packing.op9_token_output(spark, "/root/testdata/sf0.001").collect())
    assert [r["doc_id"] for r in rows] == sorted(texts)
    at = 0
    for r in rows:
        ids = [*tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 2]
        assert (r["start"], r["n_tokens"]) == (at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
