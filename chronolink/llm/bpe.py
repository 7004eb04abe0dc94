"""Byte-level BPE over overlapping chunks, and back to bytes.

A document of more than ``chunk`` characters is cut into chunks that overlap. Each chunk is pre-tokenised by
itself: around a border, one pass begins before it and one at it, and where their pre-token borders first
coincide the two chunks meet. Chunks are encoded between these meeting points, in parallel, and their ids are
put together in order. A document where a chunk finds no such point, or where its own pre-tokens miss it, is
encoded in one piece, so ids are always those of the whole text. Shorter documents are one chunk.

The pre-token pattern must not look behind; it is the public one of the rank files unless another is given.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read, small

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a chunk, and those that neighbours share on either side of a border.
CHUNK = 1 << 16
OVERLAP = 1 << 10


@dataclass(frozen=True)
class Vocabulary:
    """Where the ranks are and the pre-token pattern; None: those of the public tokenizers."""

    path: str | None = None
    pattern: str | None = None


@lru_cache(maxsize=4)
def _load(vocabulary: Vocabulary):
    path, pattern = vocabulary.path, vocabulary.pattern
    if path is None or pattern is None:
        import public_tokenizers

        path = path or public_tokenizers.path(RANKS)
        pattern = pattern or public_tokenizers.PATTERN
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(t): int(i) for t, i in (line.split() for line in lines if line.strip())}
    encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding, regex.compile(pattern), ranks


@lru_cache(maxsize=4)
def _bytes_by_id(vocabulary: Vocabulary) -> list[bytes]:
    ranks = _load(vocabulary)[2]
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, i in ranks.items():
        table[i] = token
    return table


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def meeting_point(pattern, window: str, border: int) -> int | None:
    """Where pre-tokens of ``window`` read from its start and from ``border`` first have the same border.

    Only points after a character that is no white space, and clear of the end of the window, count: there
    the text before can be pre-tokenised without the text after it.
    """
    limit = len(window) - 4
    from_start = {m.start() for m in pattern.finditer(window)}
    for m in pattern.finditer(window, border):
        at = m.start()
        if at > limit:
            break
        if at > border and at in from_start and not window[at - 1].isspace():
            return at
    return None


def encode_chunk(vocabulary: Vocabulary, body: str, left: int, size: int, last: bool, overlap: int):
    """The ids of a chunk between its meeting points, or None if it cannot tell them.

    ``body`` has the chunk at ``left`` with its overlaps on both sides.
    """
    encoding, pattern, _ = _load(vocabulary)
    begin, end = 0, len(body)
    if left:
        window = body[left - overlap : left + overlap]
        if (point := meeting_point(pattern, window, overlap)) is None:
            return None
        begin = left - overlap + point
    if not last:
        start = left + size - overlap
        if (point := meeting_point(pattern, body[start:], overlap)) is None:
            return None
        end = start + point
        if all(m.start() != end for m in pattern.finditer(body, begin)):
            return None
    return _packed(encoding.encode_ordinary(body[begin:end]))


def _encode_short(vocabulary: Vocabulary, keep: list[str]):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _load(vocabulary)[0]
        for batch in small(batches):
            ids = [_packed(encoding.encode_ordinary(t or "")) for t in batch["_text"].to_pylist()]
            columns = [batch[c] for c in keep] + [pa.array(ids, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "ids"])

    return run


_CHUNKS = "_id {id}, _digest binary, _no int, _left int, _last boolean, _body string"
_CODED = "_id {id}, _digest binary, _no int, _ids binary, _own string"


def _cut(chunk: int, overlap: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch["_id"].to_pylist(), batch["_text"].to_pylist(), strict=True):
                digest = hashlib.md5(text.encode(), usedforsecurity=False).digest()
                count = len(text) // chunk  # the last chunk has what is left, too
                for no in range(count):
                    left, last = min(overlap, no * chunk), no + 1 == count
                    end = len(text) if last else (no + 1) * chunk + overlap
                    row = [[key], [digest], [no], [left], [last], [text[no * chunk - left : end]]]
                    types = [batch.schema.field("_id").type, pa.binary(), pa.int32(), pa.int32()]
                    types += [pa.bool_(), pa.string()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(v, t) for v, t in zip(row, types, strict=True)],
                        ["_id", "_digest", "_no", "_left", "_last", "_body"],
                    )

    return run


def _encode_chunks(vocabulary: Vocabulary, chunk: int, overlap: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = [], []
            for left, last, body in zip(
                *(batch[c].to_pylist() for c in ("_left", "_last", "_body")), strict=True
            ):
                ids.append(encode_chunk(vocabulary, body, left, chunk, last, overlap))
                own.append(body[left:] if last else body[left : left + chunk])
            yield pa.RecordBatch.from_arrays(
                [batch["_id"], batch["_digest"], batch["_no"], pa.array(ids, pa.binary()), pa.array(own)],
                ["_id", "_digest", "_no", "_ids", "_own"],
            )

    return run


def _put_together(vocabulary: Vocabulary):
    """Chunks come sorted by document and position; of repeated rows, each position comes repeatedly."""

    def rows(batches):
        for batch in batches:
            yield from zip(*(batch[c].to_pylist() for c in batch.schema.names), strict=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, types = _load(vocabulary)[0], None

        def typed(batches):
            nonlocal types
            for batch in batches:
                types = batch.schema.field("_id").type
                yield batch

        for (key, _), chunks in groupby(rows(typed(batches)), lambda r: r[:2]):
            copies, ids, own, seen = 0, [], [], -1
            for _, _, no, coded, text in chunks:
                copies += no == 0
                if no != seen:
                    ids.append(coded)
                    own.append(text)
                    seen = no
            whole = encoding.encode_ordinary("".join(own)) if None in ids else None
            packed = b"".join(ids) if whole is None else _packed(whole)
            for _ in range(copies):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key], types), pa.array([packed], pa.binary())], ["_id", "ids"]
                )

    return run


def encode(
    docs: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    vocabulary: Vocabulary = Vocabulary(),
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per document: its id and ``ids``, little-endian unsigned 32-bit token ids.

    Text is ordinary text: names of special tokens get no ids of their own. A null or empty text has empty
    ids; repeated rows give repeated results; an empty table gives an empty table; other columns are ignored.
    """
    if overlap > chunk:
        raise ValueError("chunks must be at least as long as their overlap")
    plain = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    kind = plain.schema["_id"].dataType.simpleString()
    long = F.coalesce(F.length("_text") > chunk, F.lit(False))
    short = plain.filter(~long).mapInArrow(_encode_short(vocabulary, ["_id"]), f"_id {kind}, ids binary")
    cut = (
        plain.filter(long)
        .mapInArrow(_cut(chunk, overlap), _CHUNKS.format(id=kind))
        .repartition("_id", "_digest", "_no")
        .mapInArrow(_encode_chunks(vocabulary, chunk, overlap), _CODED.format(id=kind))
        .repartition("_id", "_digest")
        .sortWithinPartitions("_id", "_digest", "_no")
        .mapInArrow(_put_together(vocabulary), f"_id {kind}, ids binary")
    )
    return short.unionByName(cut).withColumnRenamed("_id", id)


def decode(encoded: DataFrame, *, vocabulary: Vocabulary = Vocabulary()) -> DataFrame:
    """Add ``bytes``, the raw bytes of the tokens in ``ids``, one after another; null ids give null."""
    kept = [c for c in encoded.columns if c != "bytes"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _bytes_by_id(vocabulary)
        for batch in small(batches):
            texts = [
                None if raw is None else b"".join([table[i] for i in np.frombuffer(raw, "<u4").tolist()])
                for raw in batch["ids"].to_pylist()
            ]
            columns = [batch[c] for c in kept] + [pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "bytes"])

    schema = encoded.select(*kept).withColumn("bytes", F.lit(None).cast("binary")).schema
    return encoded.select(*kept).mapInArrow(run, schema)


def digests(docs: DataFrame, **options) -> DataFrame:
    """Encode and decode: ``n_tokens`` and the SHA-256 of ids and of decoded bytes per document."""
    back = decode(encode(docs, **options), vocabulary=options.get("vocabulary", Vocabulary()))
    return back.select(
        options.get("id", "doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read(spark, sf_dir, "documents"))
