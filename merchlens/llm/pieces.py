"""SentencePiece encoding and decoding by a prefix table, for merge-type (BPE) vocabularies.

Of every prefix of a text the encoding ends in exactly one piece. An automaton over the vocabulary
lists the pieces that end at a place; that one is the last piece of its prefix which goes together
with the last piece of the prefix before it, that is: merging the two pieces' characters from the
start gives the two pieces again. The table of last pieces is filled from left to right, the ids are
read from it backwards. Time is linear in the text, whatever it holds; the tests of pairs are kept.

No piece of a usual vocabulary holds a space after another character, so a text may be cut before
each space that follows another character, and every distinct unit of a block of rows is encoded
once. Vocabularies with such pieces are encoded text by text. Characters without a piece become
byte pieces. Vocabularies with a normalisation table, with user-defined or unused pieces, or
without byte pieces are refused.

Defined cases: null and empty texts have the end id only; U+2581 counts as a space; repeated rows are
encoded each; a null doc_id is carried; an empty table gives an empty result; other columns are never
read. ``decode`` takes any ids of the vocabulary: control ids are nothing, the unknown id is its
surface, bytes that are no UTF-8 become U+FFFD each.
"""

from __future__ import annotations

import codecs
from array import array
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm.common import as_array, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
# Piece kinds of the model format, and what the unknown id decodes to.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
UNKNOWN_SURFACE = " ⁇ "
#: Text bytes that are taken at a time, units and pairs that a process keeps, and the longest kept unit.
BLOCK_BYTES = 2 << 20
KEPT_UNITS, KEPT_PAIRS, KEPT_LENGTH = 200_000, 500_000, 200


def _fields(data: bytes):
    """(field number, value) of a protocol-buffer message; numbers, or bytes of nested fields."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            part = data[at]
            at += 1
            value |= (part & 127) << shift
            shift += 7
            if part < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or number()
        yield tag >> 3, data[at : at + size]
        at += size


def _one_mark_per_byte(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("merchlens.marks", _one_mark_per_byte)


class Pieces:
    """A vocabulary read from the bytes of a model file."""

    def __init__(self, model: bytes) -> None:
        import ahocorasick

        self.names, scores, self.kinds = [], [], []
        normalizer: dict = {}
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                self.names.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0]))
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 3:
                normalizer = dict(_fields(value))
        # Names of the fields: 2 table, 3 space before the text, 4 fewer spaces, 5 spaces as U+2581.
        plain = not normalizer.get(2) and normalizer.get(3, 1) and not normalizer.get(4, 1) and normalizer.get(5, 1)
        if not plain or not set(self.kinds) <= {NORMAL, UNKNOWN, CONTROL, BYTE} or self.kinds.count(BYTE) != 256:
            raise ValueError("only plain vocabularies with byte pieces are supported")
        self.size = len(self.names)
        self.ids = {n: i for i, n in enumerate(self.names) if self.kinds[i] == NORMAL}
        self.bytes = {int(n[3:5], 16): i for i, n in enumerate(self.names) if self.kinds[i] == BYTE}
        self.end = self.names.index("</s>")
        self.rank = {n: -scores[i] for n, i in self.ids.items()}
        self.splits = not any(SPACE in n.lstrip(SPACE) for n in self.ids)
        # What is known of the pairs that end in a piece, by the token before it; the piece brings it along in a match.
        self.pairs: dict[int, dict[int, bool]] = {i: {} for i in self.ids.values()}
        self.kept = 0
        self.automaton = ahocorasick.Automaton()
        for name, i in self.ids.items():
            self.automaton.add_word(name, (i, len(name), self.pairs[i]))
        self.automaton.make_automaton()
        # Units of late and of the time before: what comes again and again is never lost.
        self.units: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.sizes = [len(n) for n in self.names]
        surfaces = [
            bytes([int(n[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else UNKNOWN_SURFACE.encode() if k == UNKNOWN
            else n.replace(SPACE, " ").encode() for n, k in zip(self.names, self.kinds, strict=True)
        ]
        self.lengths = np.fromiter(map(len, surfaces), np.int64, self.size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surfaces = surfaces
        self.leads = np.array([k == NORMAL and n.startswith(SPACE) for n, k in zip(self.names, self.kinds, strict=True)])
        self.empty = self.lengths == 0
        self.raw = np.array(self.kinds) == BYTE

    def _text(self, token: int) -> str:
        """A token of the table: a piece, or a character without one (its code point after the vocabulary)."""
        return self.names[token] if token < self.size else chr(token - self.size)

    def _merged(self, symbols: list[str]) -> list[str]:
        """Merging from the start: of all neighbours that join to a piece the best scored, leftmost first."""
        while True:
            joined = [self.rank.get(a + b, np.inf) for a, b in zip(symbols, symbols[1:], strict=False)]
            best = min(joined, default=np.inf)
            if best == np.inf:
                return symbols
            at = joined.index(best)
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def together(self, left: int, right: int) -> bool:
        """Whether the two tokens stay as they are when their characters are merged (left -1: the text's start)."""
        own = self.pairs.setdefault(right, {})
        known = own.get(left)
        if known is None:
            tokens = [self._text(t) for t in (left, right) if t >= 0]
            known = self._merged(list("".join(tokens))) == tokens
            if self.kept >= KEPT_PAIRS:
                for kept in self.pairs.values():
                    kept.clear()
                self.kept = 0
            own[left] = known
            self.kept += 1
        return known

    def _table(self, text: str):
        """The last token of every prefix of ``text``; behind them -1, which is also what stands before the text."""
        together, many = self.together, len(text) + 1
        last = [-1] * many if many <= KEPT_LENGTH else array("i", [-1]) * many
        place = -1  # up to there every prefix has its token
        for at, (piece, length, own) in self.automaton.iter(text):
            if at == place:
                continue  # found; other pieces end here too
            while place < at - 1:  # no piece that fits ends there: the character stands for itself
                place += 1
                last[place] = self.size + ord(text[place])
            before = last[at - length]
            known = own.get(before)
            if known if known is not None else together(before, piece):
                last[at] = piece
                place = at
        for at in range(place + 1, len(text)):
            last[at] = self.size + ord(text[at])
        return last

    def encode_unit(self, unit: str, keep: bool = True) -> bytes:
        """Ids (int32) of a text whose spaces are U+2581 and whose first space stands there already; kept if told so."""
        known = self.units.get(unit)
        if known is not None:
            return known
        known = self.before.get(unit)
        if known is not None:
            self.units[unit] = known
            return known
        last, out, at, sizes = self._table(unit), array("i"), len(unit) - 1, self.sizes
        while at >= 0:
            token = last[at]
            if token < self.size:
                out.append(token)
                at -= sizes[token]
            else:
                out.extend(self.bytes[b] for b in reversed(unit[at].encode()))
                at -= 1
        out.reverse()
        ids = out.tobytes()
        if keep and len(unit) <= KEPT_LENGTH:
            if len(self.units) >= KEPT_UNITS:
                self.before, self.units = self.units, {}
            self.units[unit] = ids
        return ids

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text, the end id last."""
        codes, offsets, found = units(pc.replace_substring(as_array(texts), SPACE, " "), bool if self.splits else lambda part: False)
        ids = [self.encode_unit((" " + u).replace(" ", SPACE)) for u in found]
        ids.append(np.int32(self.end).tobytes())
        codes = np.insert(codes, offsets[1:], len(found))
        offsets = offsets + np.arange(len(offsets))
        flat, ends = gathered(ids, codes)
        return pa.ListArray.from_arrays(pa.array(ends[offsets], pa.int32()), pa.array(flat))

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids."""
        flat, offsets = ids.flatten().to_numpy(zero_copy_only=False), ids.offsets.to_numpy().astype(np.int64)
        flat, offsets = np.asarray(flat, np.int64), offsets - offsets[0]
        sizes = self.lengths[flat]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        data = self.surface[np.arange(ends[-1]) + np.repeat(self.starts[flat] - ends[:-1], sizes)]
        bounds = ends[offsets]
        # The space before the text goes: that of the first id that is not nothing.
        shown = np.concatenate([np.flatnonzero(~self.empty[flat]), [len(flat)]])
        first = shown[np.searchsorted(shown, offsets[:-1])]
        lead = (first < offsets[1:]) & np.append(self.leads[flat], False)[np.minimum(first, len(flat))]
        raw = data.tobytes()
        texts = [raw[a + l : b].decode("utf-8", "merchlens.marks") for a, b, l in zip(bounds, bounds[1:], lead, strict=False)]
        # Bytes before and after an id that is nothing belong to different characters.
        cut = np.flatnonzero(self.raw[flat[:-1]] & self.empty[flat[1:]]) + 1
        rows = np.searchsorted(offsets, cut, "right") - 1
        for row in np.unique(rows[(cut > offsets[rows]) & (cut < offsets[rows + 1] - 1)]).tolist():
            own = flat[offsets[row] : offsets[row + 1]].tolist()
            runs = (b"".join(self.surfaces[i] for i in run) for _, run in groupby(own, lambda i: bool(self.empty[i])))
            texts[row] = "".join(r.decode("utf-8", "merchlens.marks") for r in runs)[int(lead[row]) :]
        return pa.array(texts, pa.string())


def gathered(values: list[bytes], codes: np.ndarray, kind=np.int32) -> tuple[np.ndarray, np.ndarray]:
    """The arrays ``values[code]`` one after the other, and where each begins (and the last ends)."""
    pool = np.frombuffer(b"".join(values), kind)
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // pool.itemsize
    starts = np.cumsum(sizes) - sizes
    many = sizes[codes]
    ends = np.concatenate([[0], np.cumsum(many)])
    return pool[np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], many)], ends


def units(texts: pa.Array, closes) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Texts cut before spaces: codes of units, offsets of each text, and the distinct units without their first space.

    A unit ends where ``closes`` holds for the part before a space, or with its text; an empty text has none.
    """
    texts = as_array(texts)
    parts = pc.split_pattern(texts, " ")
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    if not full.all():  # an empty text splits into one empty part
        kept = np.repeat(full, np.diff(offsets))
        flat = flat.filter(pa.array(kept))
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets]
    coded = flat.dictionary_encode()
    found, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
    closed = np.fromiter(map(closes, found), bool, len(found))[codes]
    closed[offsets[1:][full] - 1] = True
    ends = np.flatnonzero(closed)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    out = codes[ends]
    joined: dict[str, int] = {}
    many = len(found)
    for k in np.flatnonzero(starts != ends).tolist():
        unit = " ".join([found[c] for c in codes[starts[k] : ends[k] + 1].tolist()])
        out[k] = many + joined.setdefault(unit, len(joined))
    return out, np.concatenate([[0], np.cumsum(closed)])[offsets], found + list(joined)


def blocks(batch: pa.RecordBatch, column: int, most: int = BLOCK_BYTES):
    """Pieces of a batch with at most ``most`` bytes of text each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    total = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(total, total[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def read_model(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file, read through Spark; bounded by the vocabulary."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


@lru_cache(maxsize=2)
def vocabulary(model: bytes) -> Pieces:
    """Built once per process."""
    return Pieces(model)


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(read_model(spark, path))

    def of(batches):
        pieces = vocabulary(sent.value)
        for batch in batches:
            for some in blocks(batch, 1):
                yield pa.RecordBatch.from_arrays([some.column(0), pieces.encode(some.column(1))], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``encoded`` (doc_id, ids) with the text that the ids stand for (``decoded``); null ids: empty."""
    spark = encoded.sparkSession
    sent = spark.sparkContext.broadcast(read_model(spark, path))

    def of(batches):
        pieces = vocabulary(sent.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.slice(start, 1000)
                yield pa.RecordBatch.from_arrays([*some.columns, pieces.decode(some.column(1))], ["doc_id", "ids", "decoded"])

    given = encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return given.mapInArrow(of, "doc_id long, ids array<int>, decoded string")


def digest(values: Column) -> Column:
    """SHA-256 of numbers in decimal, joined by spaces."""
    return F.sha2(F.array_join(values.cast("array<string>"), " "), 256)


def op11_pieces(spark, sf_dir: str) -> DataFrame:
    decoded = decode(encode(table(spark, sf_dir, "documents")))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), digest(F.col("ids")).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
