"""Cross-tokenizer alignment: which tokens of a byte-level vocabulary (A) stand for which pieces (B).

Both tokenise a space and the text. Every token points to the token farthest to the right that it
overlaps: that of the other side that covers its last byte, or itself where both end there (of the
two that end together, B's). Doubling these pointers for all tokens of a block of rows at once
brings every token to the last one of its component within log2(length) rounds; that one is the
component's label, and the labels in order are the groups. A text is cut where both vocabularies
are known to begin a token (before a space after anything but white space), so each distinct unit
of a block is tokenised and aligned once.

The tokens that end a group together are a link. Two ids can only be linked if the bytes of one end
with the bytes of the other, so the different pairs are bounded by the vocabularies (``most_pairs``,
some 400,000 for the two used here), whatever the corpus; only their counts, never anything of a
document, go through the driver to the tasks.

Defined cases: texts that are null or empty, and those whose token bytes differ from the space and
the text (a U+2581 in it), have no tokens, no groups and no links; repeated rows are aligned and
counted each; a null doc_id is carried; an empty table gives an empty result; other columns are
never read. Names of special tokens inside a text are plain text.
"""

from __future__ import annotations

import os
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.llm import pieces
from merchlens.llm.common import as_array, store, table

BYTES_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECES_VOCABULARY = pieces.VOCABULARY
#: Units a process keeps between blocks.
KEPT_UNITS = 40_000
#: Characters that one of the two may take as white space.
BLANK = "᠎​﻿"
SHIFT = 2**32


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones themselves, others from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def _bytes_tokenizer(model: bytes):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_str(model.decode())
    tokenizer.encode_special_tokens = True
    return tokenizer


def surfaces(bytes_model: bytes, pieces_model: bytes) -> tuple[list[bytes], list[bytes]]:
    """The bytes of every id of both vocabularies."""
    vocabulary, letters = _bytes_tokenizer(bytes_model).get_vocab(with_added_tokens=False), byte_alphabet()
    a = [b""] * (max(vocabulary.values()) + 1)
    for name, i in vocabulary.items():
        a[i] = bytes(letters[c] for c in name)
    return a, pieces.vocabulary(pieces_model).surfaces


def most_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many pairs of ids can end together: the bytes of one are an end of the bytes of the other."""
    def ends(these: Counter, others: Counter) -> int:
        return sum(n * others[x[k:]] for x, n in these.items() for k in range(len(x)))

    of_a, of_b = Counter(x for x in a if x), Counter(x for x in b if x)
    return ends(of_a, of_b) + ends(of_b, of_a) - sum(n * of_b[x] for x, n in of_a.items())


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The label of every A token and every B token: the number of the B token that ends their component.

    Both are increasing ends of tokens that cover the same bytes. Pointers are doubled until none moves.
    """
    n = len(ends_a)
    over_b = np.searchsorted(ends_b, ends_a, "left")  # B token with A's last byte
    over_a = np.searchsorted(ends_a, ends_b, "left")
    own = np.arange(len(ends_b)) + n
    follow = np.concatenate([over_b + n, np.where(ends_a[over_a] == ends_b, own, over_a) if n else own])
    while True:
        twice = follow[follow]
        if (twice == follow).all():
            return follow[:n] - n, follow[n:] - n
        follow = twice


def _sums(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``many`` values."""
    total, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(many)
    return total[ends] - total[ends - many]


def _concatenated(values: pa.Array, ids: np.ndarray) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of ``values[ids]`` one after the other, and where each begins (and the last ends)."""
    taken = values.take(pa.array(ids))
    ends = np.frombuffer(taken.buffers()[1], np.int32, len(ids) + 1) if len(ids) else np.zeros(1, np.int32)
    data = taken.buffers()[2] if len(ids) else None
    return (data if data is not None else pa.py_buffer(b"")).slice(0, int(ends[-1])), ends


class Aligner:
    """Both vocabularies, and what is known of units: n_a, n_b and the tokens of the groups.

    The tokens stand group by group, A's before B's, as id + ``width`` * k, where k tells what follows in
    the text of the groups: 0 another token of the side, 1 the other side, 2 another group, 3 nothing.
    """

    def __init__(self, bytes_model: bytes, pieces_model: bytes) -> None:
        import sentencepiece

        self.tokenizer = _bytes_tokenizer(bytes_model)
        own = pieces.vocabulary(pieces_model)
        self.library, self.space = sentencepiece.SentencePieceProcessor(model_proto=pieces_model), own.ids[pieces.SPACE]
        if not own.splits:
            raise ValueError("a piece holds a space after another character: texts cannot be cut before spaces")
        a, b = surfaces(bytes_model, pieces_model)
        self.a, self.b = pa.array(a, pa.binary()), pa.array(b, pa.binary())
        self.size_a = np.fromiter(map(len, a), np.int64, len(a))
        self.size_b = np.fromiter(map(len, b), np.int64, len(b))
        self.width = max(len(a), len(b))
        self.names = pa.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(self.width)])
        # Units of late and of the time before: what comes again and again is never lost.
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}

    def _learn(self, texts: list[str]) -> list[tuple | None]:
        """What is to be known of each of ``texts`` (units with their first space); None where the bytes differ."""
        encoded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        # The library puts the first space itself, but not before nothing.
        second = [b or [self.space] for b in self.library.encode([t[1:] for t in texts], num_threads=1)]
        n_a = np.fromiter(map(len, encoded), np.int64, len(texts))
        n_b = np.fromiter(map(len, second), np.int64, len(texts))
        flat_a = np.fromiter(chain.from_iterable(encoded), np.int64, n_a.sum())
        flat_b = np.fromiter(chain.from_iterable(second), np.int64, n_b.sum())
        raw = [t.encode() for t in texts]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        fits = (_sums(self.size_a[flat_a], n_a) == size) & (_sums(self.size_b[flat_b], n_b) == size)
        for values, flat, n in ((self.a, flat_a, n_a), (self.b, flat_b, n_b)):
            data, places = _concatenated(values, flat[np.repeat(fits, n)])
            if not data.equals(pa.py_buffer(b"".join([raw[k] for k in np.flatnonzero(fits).tolist()]))):
                bounds, data = places[np.concatenate([[0], np.cumsum(n[fits])])].tolist(), data.to_pybytes()
                for k, start, end in zip(np.flatnonzero(fits).tolist(), bounds, bounds[1:], strict=False):
                    fits[k] = data[start:end] == raw[k]
        flat_a, flat_b = flat_a[np.repeat(fits, n_a)], flat_b[np.repeat(fits, n_b)]
        out: list[tuple | None] = [None] * len(texts)
        if not fits.any():
            return out
        label_a, label_b = terminals(np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b]))
        last_b = np.flatnonzero(label_b == np.arange(len(flat_b)))  # terminal tokens, in order
        # Tokens of a group stand together: its ends on both sides tell its members.
        cut_a, cut_b = (np.searchsorted(label, last_b, "right") for label in (label_a, label_b))
        flat_a[cut_a - 1] += self.width
        flat_b[cut_b - 1] += 2 * self.width
        before_a = np.repeat(np.concatenate([[0], cut_b[:-1]]), np.diff(cut_a, prepend=0))
        before_b = np.repeat(cut_a, np.diff(cut_b, prepend=0))
        tokens = np.empty(len(flat_a) + len(flat_b), np.int32)
        tokens[np.arange(len(flat_a)) + before_a] = flat_a
        tokens[np.arange(len(flat_b)) + before_b] = flat_b
        packed, at = tokens.tobytes(), 0
        for k, of_a, of_b in zip(np.flatnonzero(fits).tolist(), n_a[fits].tolist(), n_b[fits].tolist(), strict=True):
            end = at + 4 * (of_a + of_b)
            out[k] = (of_a, of_b, packed[at:end])
            at = end
        return out

    def _facts(self, found: list[str]) -> list[tuple | None]:
        """What is known of each unit; what is not is learnt, and the short ones kept."""
        unseen: tuple = ()
        facts = [self.known.get(u, unseen) for u in found]
        late = [k for k, fact in enumerate(facts) if fact is unseen]
        for k in late:
            facts[k] = self.before.get(found[k], unseen)
        new = [k for k in late if facts[k] is unseen]
        if new:
            for k, fact in zip(new, self._learn([found[k] for k in new]), strict=True):
                facts[k] = fact
        self.known.update((found[k], facts[k]) for k in late if len(found[k]) <= pieces.KEPT_LENGTH)
        if len(self.known) >= KEPT_UNITS:
            self.before, self.known = self.known, {}
        return facts

    def align(self, texts: pa.Array) -> list[pa.Array]:
        """Columns n_a, n_b, n_groups, links and groups of each text."""
        texts = as_array(texts)
        codes, offsets, found = pieces.units(texts, lambda part: bool(part) and not (part[-1].isspace() or part[-1] in BLANK))
        facts = self._facts([" " + u for u in found])
        bad = np.fromiter((f is None for f in facts), bool, len(facts))
        if bad.any():  # such a text has no tokens at all
            hit = np.concatenate([[0], np.cumsum(bad[codes])])
            lost = hit[offsets[1:]] > hit[offsets[:-1]]
            kept = np.repeat(~lost, np.diff(offsets))
            codes, offsets = codes[kept], np.concatenate([[0], np.cumsum(kept)])[offsets]
        facts = [f or (0, 0, b"") for f in facts]
        totals = []
        for place in (0, 1):
            each = np.fromiter((f[place] for f in facts), np.int64, len(facts))
            total = np.concatenate([[0], np.cumsum(each[codes])])
            totals.append(pa.array(total[offsets[1:]] - total[offsets[:-1]]))
        tokens, ends = pieces.gathered([f[2] for f in facts], codes, np.int32)
        # The last A token and the last B token of each group are its link.
        last_b = tokens >= 2 * self.width
        last_a = (tokens >= self.width) & ~last_b
        links = (tokens[last_a] - self.width).astype(np.int64) * SHIFT + (tokens[last_b] - 2 * self.width)
        bounds = ends[offsets]
        of_text = np.concatenate([[0], np.cumsum(last_b)])[bounds]
        tokens[bounds[1:][np.diff(bounds) > 0] - 1] += self.width
        data, places = _concatenated(self.names, tokens)
        groups = pa.StringArray.from_buffers(len(texts), pa.py_buffer(places[bounds].astype(np.int32)), data)
        return [*totals, pa.array(np.diff(of_text)), pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), pa.array(links)), groups]


@lru_cache(maxsize=2)
def aligner(bytes_model: bytes, pieces_model: bytes) -> Aligner:
    return Aligner(bytes_model, pieces_model)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, links array<long>, groups string"


def align(docs: DataFrame, bytes_path: str = BYTES_VOCABULARY, pieces_path: str = PIECES_VOCABULARY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts, links (A id * 2^32 + B id) in order, and the groups
    as text (``a1,a2|b1;a3|b2,b3``; no tokens: empty)."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast((pieces.read_model(spark, bytes_path), pieces.read_model(spark, pieces_path)))

    def of(batches):
        own = aligner(*sent.value)
        for batch in batches:
            for some in pieces.blocks(batch, 1, pieces.BLOCK_BYTES // 2):
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), *own.align(some.column(1))], ["doc_id", "n_a", "n_b", "n_groups", "links", "groups"]
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, ALIGNED)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(a, b, links, is_best): how many links of the corpus hold each pair, and whether no A id has more with its B id."""
    counts = aligned.select(F.explode("links").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("links"))
    counts = store(
        counts.select("pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(SHIFT - 1).alias("b"), "links"), "pair-counts"
    )
    most = counts.groupBy(F.col("b").alias("_b")).agg(F.max("links").alias("_most"))
    return counts.join(most, F.col("b") == F.col("_b")).select("a", "b", "links", (F.col("links") == F.col("_most")).alias("is_best"))


def score_links(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` (any columns but ``links``, which is used up) with n_best and count_sum over its links.

    ``counts`` is what ``pair_counts`` gives: bounded by the two vocabularies, see the module's text.
    """
    spark = aligned.sparkSession
    table_ = counts.select((F.col("a") * SHIFT + F.col("b")).alias("pair"), "links", "is_best").orderBy("pair").toArrow()
    sent = spark.sparkContext.broadcast((
        table_["pair"].to_numpy(), table_["links"].to_numpy(), table_["is_best"].to_numpy().astype(np.int64),
    ))
    kept = [c for c in aligned.columns if c != "links"]
    fields = aligned.select(*kept).schema.add("n_best", "long").add("count_sum", "long")

    def of(batches):
        pairs, links, best = sent.value
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            offsets = lists.offsets.to_numpy().astype(np.int64)
            at = np.searchsorted(pairs, lists.flatten().to_numpy(zero_copy_only=False))
            offsets = offsets - offsets[0]
            sums = []
            for value in (best, links):
                total = np.concatenate([[0], np.cumsum(value[at] if len(at) else at)])
                sums.append(pa.array(total[offsets[1:]] - total[offsets[:-1]], pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *sums], [*kept, "n_best", "count_sum"])

    return aligned.select(*kept, "links").mapInArrow(of, fields)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = align(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("long").alias("n_links"), "links",
        F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )
    aligned = store(aligned, "aligned")
    return score_links(aligned, pair_counts(aligned)).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
