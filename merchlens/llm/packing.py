"""Token-ID output: documents packed into rows of fixed length by best-fit-decreasing.

Every text is tokenised whole with a public byte-level vocabulary and ends with ``end``. A
document longer than a row is cut into full rows and one rest; nothing is lost or cut off.
Pieces are placed longest first into the fullest row that still takes them; a segment tree over
free capacities finds it in log2(length) steps. Documents are packed in blocks of about
``BLOCK_TOKENS`` where they are read, so nothing is shuffled and a task holds one block at a time.

A packed row holds its ids (``length`` of them, padded with ``end``), positions that start at 0 in
every segment, cumulative segment lengths from 0, and per segment the document and the place of the
piece in it. Ids are little-endian ``uint16`` up to 65,536 ids, else ``uint32``.

Defined cases: null and empty texts are one ``end``; repeated rows are packed each; a null doc_id is
carried; an empty table gives an empty result; other columns are never read. Which documents share a
row follows from how the input is split into tasks.
"""

from __future__ import annotations

import base64
import posixpath
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from merchlens.llm.common import as_array, slices, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern published with the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LENGTH = 2048
BLOCK_TOKENS = 2_000_000
BLOCK_PIECES = 20_000


class Tokens:
    """A vocabulary that travels to the tasks; the encoder is built once per process."""

    def __init__(self, lines: tuple[str, ...], pattern: str) -> None:
        self.lines, self.pattern = lines, pattern

    @classmethod
    def read(cls, spark, path: str = VOCABULARY, pattern: str = PATTERN) -> Tokens:
        """The vocabulary's lines (base64 of the bytes, rank), read through Spark; bounded by the vocabulary."""
        return cls(tuple(r.value for r in spark.read.text(path).collect() if r.value), pattern)

    @property
    def end(self) -> int:
        return len(self.lines)

    def encoder(self):
        return _encoder(self.lines, self.pattern)

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text. White space starts a token of its own before a word, so a text may be cut
        before a single space between other characters: each distinct word is encoded once."""
        encoder = self.encoder()
        texts = as_array(texts)
        parts = pc.split_pattern(texts, " ")
        flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
        offsets = offsets - offsets[0]
        coded = flat.dictionary_encode()
        words, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        safe = np.fromiter((bool(w) and not w[0].isspace() and not w[-1].isspace() for w in words), bool, len(words))
        ids = [np.asarray(encoder.encode_ordinary(" " + w), np.uint32) if s else np.zeros(0, np.uint32)
               for w, s in zip(words, safe, strict=True)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        pool = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        out = []
        for row in range(len(texts)):
            own = codes[offsets[row] : offsets[row + 1]]
            if len(own) and safe[own].all():
                head = np.asarray(encoder.encode_ordinary(words[own[0]]), np.uint32)
                many = sizes[own[1:]]
                at = np.arange(many.sum()) + np.repeat(starts[own[1:]] - np.cumsum(many) + many, many)
                out.append(np.concatenate([head, pool[at]]))
            else:
                out.append(np.asarray(encoder.encode_ordinary(texts[row].as_py()), np.uint32))
        return out


@lru_cache(maxsize=2)
def _encoder(lines: tuple[str, ...], pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """Open rows by free capacity; ``best`` finds the least capacity that takes a piece."""

    def __init__(self, length: int) -> None:
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: dict[int, list[int]] = {}

    def add(self, capacity: int, row: int) -> None:
        self.rows.setdefault(capacity, []).append(row)
        node = self.leaves + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def best(self, size: int) -> tuple[int, int] | None:
        """Take out the row with the least capacity of at least ``size``."""
        node = self.leaves + size
        if not self.count[node]:
            # Up until a right sibling holds a row, then down to its leftmost one.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        row = self.rows[capacity].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return capacity, row


def best_fit(sizes: np.ndarray, length: int) -> list[list[int]]:
    """Rows of pieces (by number), each within ``length``; sizes lie between 1 and ``length``."""
    rows: list[list[int]] = []
    free = Capacities(length)
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        found = free.best(size)
        if found is None:
            capacity, row = length, len(rows)
            rows.append([])
        else:
            capacity, row = found
        rows[row].append(piece)
        if capacity > size:
            free.add(capacity - size, row)
    return rows


SCHEMA = T.StructType([
    T.StructField("block", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("n_tokens", T.IntegerType()),
    T.StructField("ids", T.BinaryType()), T.StructField("positions", T.BinaryType()),
    T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("parts", T.ArrayType(T.IntegerType())),
])


def id_type(tokens: Tokens) -> np.dtype:
    return np.dtype("<u2") if tokens.end < 65536 else np.dtype("<u4")


def _pack_block(docs: list[tuple], block: str, tokens: Tokens, length: int):
    sizes, piece = [], []
    for number, (_, ids) in enumerate(docs):
        for part, start in enumerate(range(0, len(ids), length)):
            sizes.append(min(length, len(ids) - start))
            piece.append((number, part, start))
    rows = best_fit(np.array(sizes), length)
    kind = id_type(tokens)
    ramp = np.arange(length, dtype=kind)
    out: list[list] = [[] for _ in SCHEMA]
    for number, members in enumerate(rows):
        row, places = np.full(length, tokens.end, kind), np.zeros(length, kind)
        ends, at = [0], 0
        for m in members:
            doc, _, start = piece[m]
            size = sizes[m]
            row[at : at + size] = docs[doc][1][start : start + size]
            places[at : at + size] = ramp[:size]
            at += size
            ends.append(at)
        values = (block, number, at, row.tobytes(), places.tobytes(), ends,
                  [docs[piece[m][0]][0] for m in members], [piece[m][1] for m in members])
        for column, value in zip(out, values, strict=True):
            column.append(value)
        if sum(map(len, out[3])) > 16_000_000:
            yield _batch(out)
            out = [[] for _ in SCHEMA]
    if out[0]:
        yield _batch(out)


def _batch(columns: list[list]) -> pa.RecordBatch:
    types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], SCHEMA.names)


def pack(docs: DataFrame, tokens: Tokens | None = None, length: int = LENGTH) -> DataFrame:
    """One row per packed row, see the module's text."""
    if not 0 < length <= 65535:
        raise ValueError("a row has between 1 and 65,535 tokens")
    sent = docs.sparkSession.sparkContext.broadcast(tokens or Tokens.read(docs.sparkSession))

    def of(batches):
        own = sent.value
        partition, block, held, pieces, size = TaskContext.get().partitionId(), 0, [], 0, 0
        for batch in batches:
            for some in slices(batch, 1000):
                for doc_id, ids in zip(some.column(0).to_pylist(), own.encode(some.column(1)), strict=True):
                    held.append((doc_id, np.append(ids, own.end)))
                    size += len(ids) + 1
                    pieces += 1 + len(ids) // length
                    if size >= BLOCK_TOKENS or pieces >= BLOCK_PIECES:
                        yield from _pack_block(held, f"{partition:06d}-{block:06d}", own, length)
                        block, held, pieces, size = block + 1, [], 0, 0
        if held:
            yield from _pack_block(held, f"{partition:06d}-{block:06d}", own, length)

    return docs.select(docs.doc_id.cast("long").alias("doc_id"), "text").mapInArrow(of, SCHEMA)


def write_matrices(packed: DataFrame, folder: str) -> DataFrame:
    """Binary files of packed rows, one set per task: ``.ids`` and ``.positions`` (rows x length) and
    ``.cu_seqlens`` (int32 per row: how many, then the ends). Returns (name, rows, bytes), lazily: each
    attempt of a task writes files of its own name, and only those listed count."""
    import uuid

    def of(batches):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        rows = size = 0
        with (
            system.open_output_stream(posixpath.join(base, f"{name}.ids")) as ids,
            system.open_output_stream(posixpath.join(base, f"{name}.positions")) as places,
            system.open_output_stream(posixpath.join(base, f"{name}.cu_seqlens")) as ends,
        ):
            for batch in batches:
                for a, b, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    ids.write(a)
                    places.write(b)
                    ends.write(np.array([len(c), *c], "<i4").tobytes())
                    rows, size = rows + 1, size + len(a)
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows]), pa.array([size])], ["name", "rows", "bytes"])

    return packed.select("ids", "positions", "cu_seqlens").mapInArrow(of, "name string, rows long, bytes long")


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
