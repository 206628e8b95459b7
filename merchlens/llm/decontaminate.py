"""Benchmark decontamination: item-sized windows, SimHash, multi-index blocks, exact verification.

A window of a document is as long as a benchmark item (or the whole document, if that is
shorter). Its fingerprint is the 64-bit SimHash of its five-word shingles, each weighing its
bytes. A window is a candidate for every item of its size at Hamming distance ``RADIUS`` or
less; those are found by eight blocks of eight bits: two fingerprints within 16 differ by at
most 2 in some block, so looking up every block with its neighbours at 2 misses none.
Candidates are verified by the weighted Jaccard similarity of the shingle multisets.

Before fingerprints are made, windows whose shingles that occur in the benchmark weigh less
than ``least`` times the lightest item of their size are set aside: they cannot reach the
similarity, so the result is that of fingerprinting every window. The scan is one pass without
a shuffle. The benchmark travels to the tasks in parts of at most about ``PART_WORDS`` words;
a larger benchmark takes more passes.

Defined cases: case of A-Z and white space do not count; null or empty texts and items match
nothing; an item of fewer than five words is one shingle and matches where those words stand;
repeated rows are reported each; a null doc_id or item_id is carried; empty tables give an
empty result (or all documents); columns other than id and text are only passed through.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.llm.common import as_array, slices, split_words, table

WIDTH = 5
LEAST = 0.8
RADIUS = 16
PART_WORDS = 500_000
#: Texts that a task works on at a time.
ROWS = 1000
_P = np.uint64(0x9E3779B97F4A7C15)
_BITS = 22


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of ``width`` words."""
    n = len(hashes) - width + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(width if n > 0 else 0):
        out = out * _P + hashes[k : k + n]
    return (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _fingerprints(shingles: np.ndarray, weights: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """SimHash of the windows of ``length`` shingles at ``starts``."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int64)
    total = np.vstack([np.zeros((1, 64), np.int64), np.cumsum(bits * weights[:, None], axis=0)])
    all_ = np.concatenate([[0], np.cumsum(weights)])
    ones = total[starts + length] - total[starts]
    return np.packbits(2 * ones > (all_[starts + length] - all_[starts])[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def similarity(a: list[bytes], b: list[bytes], width: int) -> float:
    """Weighted Jaccard of the shingle multisets; a shingle weighs its bytes."""
    x, y = (Counter(zip(*(w[i:] for i in range(width)), strict=False)) for w in (a, b))
    heavy = {s: sum(map(len, s)) for s in x.keys() | y.keys()}
    most = sum(w * max(x[s], y[s]) for s, w in heavy.items())
    return sum(w * min(x[s], y[s]) for s, w in heavy.items()) / most if most else 0.0


class Benchmark:
    """The items of one part, indexed by window size and by fingerprint blocks."""

    def __init__(self, items: list[tuple], least: float, radius: int) -> None:
        self.least, self.radius = least, radius
        self.ids, self.words = [], []
        by_size: dict[int, list[int]] = defaultdict(list)
        for item_id, text in items:
            words = _words(text)
            if words:
                by_size[len(words)].append(len(self.ids))
                self.ids.append(item_id)
                self.words.append(words)
        self.sizes: dict[int, tuple] = {}
        known: dict[int, list[np.ndarray]] = defaultdict(list)
        near = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)) <= radius // 8
        for size, members in sorted(by_size.items()):
            width, fps, lightest = min(WIDTH, size), [], None
            for i in members:
                lengths = np.fromiter(map(len, self.words[i]), np.int64, size)
                shingles = _rolled(_hash_words(self.words[i]), width)
                weights = np.convolve(lengths, np.ones(width, np.int64), "valid")
                known[width].append(shingles)
                fps.append(_fingerprints(shingles, weights, np.zeros(1, np.int64), len(shingles))[0])
                lightest = min(lightest or weights.sum(), weights.sum())
            fp = np.array(fps, np.uint64)
            blocks = fp.view(np.uint8).reshape(-1, 8)
            self.sizes[size] = (width, np.array(members), fp, [near[:, blocks[:, k]] for k in range(8)], lightest)
        self.known = {w: np.unique(np.concatenate(x)) for w, x in known.items()}
        self.maps = {}
        for w, x in self.known.items():
            self.maps[w] = np.zeros(1 << _BITS, bool)
            self.maps[w][(x >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def scan(self, texts: pa.Array):
        """Yield (row, item number, first word, words, distance, similarity), best window of each item."""
        codes, offsets, vocabulary = split_words(texts)
        words = vocabulary.cast(pa.binary()).to_pylist()
        hashes = _hash_words(words)[codes] if len(words) else np.zeros(0, np.uint64)
        lengths = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64) if len(words) else np.zeros(0, np.int64)
        found: dict[tuple[int, int], tuple] = {}
        for width, known in self.known.items():
            shingles = _rolled(hashes, width)
            hits = np.flatnonzero(self.maps[width][(shingles >> np.uint64(64 - _BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(known, shingles[hits]), len(known) - 1)
            hits = hits[known[at] == shingles[hits]]
            rows = np.searchsorted(offsets, hits, "right") - 1
            inside = hits + width <= offsets[rows + 1]
            hits, rows = hits[inside], rows[inside]
            for row in np.unique(rows):
                start, end = offsets[row], offsets[row + 1]
                own = hits[rows == row] - start
                self._windows(int(row), width, own, codes[start:end], shingles[start : end - width + 1], lengths, words, found)
        for (row, item), (s, first, size, distance) in sorted(found.items()):
            yield row, item, first, size, distance, -s

    def _windows(self, row, width, hits, codes, shingles, lengths, words, found) -> None:
        weights = np.convolve(lengths[codes], np.ones(width, np.int64), "valid")
        shared = np.zeros(len(weights) + 1, np.int64)
        shared[hits + 1] = weights[hits]
        shared = np.cumsum(shared)
        for size, (of_width, members, fps, tables, lightest) in self.sizes.items():
            if of_width != width:
                continue
            length = min(size, len(codes)) - width + 1
            starts = np.flatnonzero(shared[length:] - shared[:-length] >= self.least * lightest - 1e-9)
            if not len(starts):
                continue
            low = starts[0]
            local = _fingerprints(shingles[low : starts[-1] + length], weights[low : starts[-1] + length], starts - low, length)
            blocks = local.view(np.uint8).reshape(-1, 8)
            candidate = np.zeros((len(starts), len(members)), bool)
            for k in range(8):
                candidate |= tables[k][blocks[:, k]]
            for w, m in zip(*np.nonzero(candidate), strict=True):
                distance = int(np.bitwise_count(local[w] ^ fps[m]))
                if distance <= self.radius:
                    first = int(starts[w])
                    window = [words[c] for c in codes[first : first + length + width - 1]]
                    s = similarity(window, self.words[members[m]], width)
                    if s >= self.least:
                        best = (-s, first, len(window), distance)
                        key = (row, int(members[m]))
                        found[key] = min(found.get(key, best), best)


def parts_of(benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS) -> list:
    """The benchmark as broadcast parts of a bounded number of words each."""
    if not 0 < radius // 8 <= 8:
        raise ValueError("the radius must lie between 8 and 64")
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    parts = -(-words // PART_WORDS)
    spark = benchmark.sparkSession
    out = []
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        out.append(spark.sparkContext.broadcast(Benchmark([(r.item_id, r.text) for r in rows], least, radius)))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance, similarity): each item found in each row, at its best window."""
    schema = T.StructType([
        docs.select("doc_id").schema["doc_id"], benchmark.select("item_id").schema["item_id"],
        T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
        T.StructField("distance", T.IntegerType()), T.StructField("similarity", T.DoubleType()),
    ])
    arrow = [pa.int64(), pa.int64(), pa.int32(), pa.float64()]

    def passes(part):
        def of(batches):
            index = part.value
            for batch in batches:
                for some in slices(batch, ROWS):
                    found = list(index.scan(as_array(some.column(1))))
                    if found:
                        rows, items, *rest = zip(*found, strict=True)
                        ids = pa.array([index.ids[i] for i in items], pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [some.column(0).take(pa.array(rows)), ids, *(pa.array(x, t) for x, t in zip(rest, arrow, strict=True))],
                            schema.names,
                        )

        return docs.select("doc_id", "text").mapInArrow(of, schema)

    out = None
    for part in parts_of(benchmark.withColumn("item_id", F.col("item_id").cast("long")), least, radius):
        out = passes(part) if out is None else out.unionByName(passes(part))
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = LEAST, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` in which no item is found, all columns kept; no shuffle."""
    at = docs.columns.index("text")
    for part in parts_of(benchmark, least, radius):
        def of(batches, part=part):
            for batch in batches:
                for some in slices(batch, ROWS):
                    clean = np.ones(some.num_rows, bool)
                    for row, *_ in part.value.scan(as_array(some.column(at))):
                        clean[row] = False
                    yield some.filter(pa.array(clean))

        docs = docs.mapInArrow(of, docs.schema)
    return docs


def op3_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
