"""Token ids in files of fixed-width bits.

Documents are ordered by id over all files. Every id takes as many bits as the largest id of the vocabulary
needs. Ids are packed in blocks of a fixed count, and a file lists where its blocks begin, so that any stretch
of ids is read with a few seeks and unpacked with numpy.

File: magic, then little-endian ``bits`` u4, ``block`` u4, ``n_ids`` u8, ``n_docs`` u8; doc ids i8 x n_docs;
ends of the documents in ids u8 x n_docs; block offsets u8 x (blocks + 1), from the first packed byte; packed ids,
lowest bit first, each block filled up to whole bytes. A null doc id is written as the smallest i8.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronolink.plans.staging import new_path, stage

from .tables import read, small

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
MAGIC = b"BITTOKEN"
HEADER = "<IIQQ"
#: Ids of a block, a multiple of 8, and ids after which a file is closed.
BLOCK = 1 << 13
FILE_IDS = 1 << 23
NULL_ID = -(1 << 63)

#: Distinct pieces of text whose ids a worker remembers; the memory is emptied when it is full.
REMEMBERED = 1_200_000
#: Characters looked at together.
SPAN = 1 << 20
#: Words encoded as one text.
JOINED = 1 << 12
#: Tasks that read files back, one for each file up to this.
MAX_TASKS = 20_000

# The tokenizer never joins what white space follows with that white space, nor a letter or digit with a
# punctuation mark after it. So text may be cut there and the pieces encoded one by one.
_PIECES = re.compile(r"\s*[A-Za-z0-9À-ÖØ-öø-ɏ]+(?=[\s.,;:!?]|\Z)|\s*\S+|\s+")
_CUT = re.compile(r"\S(?=\s)")
# White space for Python, not for the tokenizer.
_UNSURE = re.compile("[\x1c-\x1f]")


class Encoder:
    """Ids of texts as the tokenizers library gives them; each distinct piece is encoded once per worker."""

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.type = "<u2" if self.size <= 1 << 16 else "<u4"
        self.known: dict[str, bytes] = {}
        # The tokenizer takes added tokens out of a text first, so one that names any is not cut.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        names = (self.tokenizer.id_to_token(i) or "" for i in range(self.size))
        self.after_space = np.array([n.startswith(space) for n in names])

    def _arrays(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=self.type) for x in found]

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces. Words with one space before them are encoded as one text and cut where an id has a space."""
        words = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        for at in range(0, len(words), JOINED):
            some = words[at : at + JOINED]
            (ids,) = self._arrays(["".join(some)])
            starts = np.flatnonzero(self.after_space[ids])
            if len(starts) == len(some):
                raw, ends = ids.tobytes(), [*(starts[1:] * ids.itemsize).tolist(), ids.nbytes]
                begins = [0, *ends[:-1]]
                self.known.update((w, raw[a:b]) for w, a, b in zip(some, begins, ends, strict=True))
        others = [p for p in pieces if p not in self.known]
        self.known.update((p, ids.tobytes()) for p, ids in zip(others, self._arrays(others), strict=True))

    def _is_sure(self, text: str) -> bool:
        return not _UNSURE.search(text) and not any(token in text for token in self.added)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        spans, owner = [], []
        for n, text in enumerate(texts):
            for span in _spans(text) if self._is_sure(text) else [text]:
                spans.append(span)
                owner.append(n)
        out: list[list[bytes]] = [[] for _ in texts]
        at = 0
        while at < len(spans):
            upto, chars = at, 0
            while upto < len(spans) and (upto == at or chars + len(spans[upto]) <= SPAN):
                chars += len(spans[upto])
                upto += 1
            for n, ids in zip(owner[at:upto], self._span_ids(spans[at:upto]), strict=True):
                out[n].append(ids)
            at = upto
        return [np.frombuffer(b"".join(parts), dtype=self.type) for parts in out]

    def _span_ids(self, spans: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        # Where pieces are not sure, the whole is the only piece.
        pieces = [_PIECES.findall(s) if self._is_sure(s) else [s] for s in spans]
        new = list(set(chain.from_iterable(pieces)).difference(self.known))
        if new:
            self._learn(new)
        return [b"".join(map(self.known.__getitem__, p)) for p in pieces]


def _spans(text: str) -> Iterator[str]:
    at = 0
    while len(text) - at > SPAN and (m := _CUT.search(text, at + SPAN)):
        yield text[at : m.end()]
        at = m.end()
    if at < len(text):
        yield text[at:] if at else text


@lru_cache(maxsize=2)
def encoder(path: str | None) -> Encoder:
    return Encoder(path)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits of every id, lowest first, filled up to whole bytes."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype("<u4")[:, None] >> np.arange(bits, dtype="<u4")) & 1
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed bytes."""
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", count).astype("<u4")
    planes = np.unpackbits(np.frombuffer(raw, np.uint8), count=count * bits, bitorder="little")
    return (planes.reshape(count, bits).astype("<u4") << np.arange(bits, dtype="<u4")).sum(1, dtype="<u4")


def file_bytes(keys: list[int], docs: list[np.ndarray], bits: int, block: int) -> bytes:
    """A whole file of the format."""
    ends = np.cumsum([len(d) for d in docs], dtype="<u8")
    ids = np.concatenate(docs) if docs else np.empty(0, "<u4")
    blocks = [pack(ids[k : k + block], bits) for k in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)], dtype="<u8")
    head = MAGIC + struct.pack(HEADER, bits, block, len(ids), len(docs))
    return b"".join([head, np.array(keys, "<i8").tobytes(), ends.tobytes(), offsets.tobytes(), *blocks])


class TokenFile:
    """Random access to one file: only the header, the index and the wanted blocks are read."""

    def __init__(self, path: str):
        filesystem, local = pafs.FileSystem.from_uri(path)
        self.file = filesystem.open_input_file(local)
        size = len(MAGIC) + struct.calcsize(HEADER)
        head = self.file.read_at(size, 0)
        if head[: len(MAGIC)] != MAGIC:
            raise ValueError(f"not a token file: {path}")
        self.bits, self.block, self.n_ids, self.n_docs = struct.unpack(HEADER, head[len(MAGIC) :])
        blocks = -(-self.n_ids // self.block)
        raw = self.file.read_at(16 * self.n_docs + 8 * (blocks + 1), size)
        self.keys = np.frombuffer(raw, "<i8", self.n_docs)
        self.ends = np.frombuffer(raw, "<u8", self.n_docs, 8 * self.n_docs)
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1, 16 * self.n_docs)
        self.data = size + len(raw)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file."""
        if start >= stop:
            return np.empty(0, "<u4")
        first, last = start // self.block, -(-stop // self.block)
        begin, end = int(self.offsets[first]), int(self.offsets[last])
        raw = self.file.read_at(end - begin, self.data + begin)
        count = min(last * self.block, self.n_ids) - first * self.block
        return unpack(raw, self.bits, count)[start - first * self.block : stop - first * self.block]

    def documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc id, position in the file, ids) of every document, in order."""
        begin = 0
        for key, end in zip(self.keys.tolist(), self.ends.tolist(), strict=True):
            yield key, begin, self.ids(begin, end)
            begin = end

    def close(self) -> None:
        self.file.close()


def _save(path: str, content: bytes) -> None:
    """Write under a name of its own, then rename: a task that runs twice leaves one whole file."""
    filesystem, local = pafs.FileSystem.from_uri(path)
    folder, _, name = local.rpartition("/")
    filesystem.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid4().hex}"
    with filesystem.open_output_stream(part) as out:
        out.write(content)
    filesystem.move(part, local)


_MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


def _write_files(folder: str, tokenizer: str | None, end_id: int, block: int, file_ids: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer)
        bits = max(1, (coder.size - 1).bit_length())
        end = np.array([end_id], dtype=coder.type)
        keys: list[int] = []
        docs: list[np.ndarray] = []
        held = 0

        def close():
            path = f"{folder}/part-{part:06d}-{seq:06d}.bin"
            _save(path, file_bytes(keys, docs, bits, block))
            row = {"part": part, "seq": seq, "path": path, "n_docs": len(docs), "n_ids": held}
            types = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row.values(), types, strict=True)], list(row)
            )

        for batch in small(batches):
            texts = [t or "" for t in batch["_text"].to_pylist()]
            for key, ids in zip(batch["_id"].to_pylist(), coder.encode(texts), strict=True):
                keys.append(NULL_ID if key is None else key)
                docs.append(np.concatenate([ids, end]))
                held += len(ids) + 1
                if held >= file_ids:
                    yield close()
                    keys, docs, held, seq = [], [], 0, seq + 1
        if docs:
            yield close()

    return run


def write(
    docs: DataFrame,
    folder: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
    block: int = BLOCK,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write all documents to token files under ``folder``; returns the list of files in order.

    ``folder`` must be shared by all executors. ``first_id`` of the list is the number of ids in all files
    before. A null or empty text is the end id alone; null document ids come first; repeated rows are written
    repeatedly; an empty table writes no file; other columns are ignored.
    """
    if block % 8:
        raise ValueError("a block must hold a multiple of 8 ids")
    ordered = (
        docs.select(F.col(id).cast("long").alias("_id"), F.col(text).alias("_text"))
        .repartitionByRange("_id")
        .sortWithinPartitions("_id", "_text")
    )
    files = stage(
        ordered.mapInArrow(_write_files(folder, tokenizer, end_id, block, file_ids), _MANIFEST), "token-files"
    )
    # One row per part in the window over parts, one per file in the other.
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("_sum"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return files.join(parts, "part").select(
        *files.columns, (F.coalesce(F.sum("n_ids").over(inside), F.lit(0)) + F.col("_before")).alias("first_id")
    )


def _read_files(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "ids"]
    types = [pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for path, first in zip(batch["path"].to_pylist(), batch["first_id"].to_pylist(), strict=True):
            file = TokenFile(path)
            rows: list[tuple] = []
            held = 0
            for key, begin, ids in file.documents():
                rows.append((None if key == NULL_ID else key, first + begin, ids.tobytes()))
                held += ids.nbytes
                if held > 1 << 24:
                    yield _batch(rows, types, names)
                    rows, held = [], 0
            file.close()
            if rows:
                yield _batch(rows, types, names)


def _batch(rows, types, names):
    arrays = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names)


def read_back(files: DataFrame) -> DataFrame:
    """Documents of the listed files: ``doc_id``, ``start`` (ids before it in all files), ``ids`` as u4."""
    # A few rows that stand for much work: without a number they would be joined into one task.
    tasks = min(max(files.count(), 1), MAX_TASKS)
    return (
        files.select("path", "first_id")
        .repartition(tasks, "path")
        .mapInArrow(_read_files, "doc_id long, start long, ids binary")
    )


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write(read(spark, sf_dir, "documents"), new_path(spark, "tokens"))
    return read_back(files).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
