"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

``features`` turns every whole text into ``STATISTICS`` numbers. ``fit`` draws random
Fourier features of a Gaussian kernel over the standardised statistics, sums the normal
equations within partitions, solves the ridge system on the driver (``FOURIER`` squared
numbers, whatever the input) and calibrates on a third of the training rows with
pool-adjacent-violators over score bins. ``score`` applies the model to any table with a text.

Defined cases: a null text counts as empty; an empty text gets the score of its (all zero)
statistics; repeated rows are scored alike; with no labels, or labels of one kind only, every
score is the share of label 1 (0.5 without any); an empty table gives an empty result; columns
other than the text are never read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.llm.common import as_array, held_out, store, training_labels

STATISTICS = 20
FOURIER = 256
#: Partitions that sum the normal equations; their sums are what the driver adds up.
FIT_PARTITIONS = 24
BINS = 1000

_KIND = np.zeros(256, np.int64)  # 0 other, 1 lower, 2 upper, 3 digit, 4 sentence mark, 5 symbol, 6 space, 7 line end
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
for _mark in b".,;:'\"-()?":
    _KIND[_mark] = 4
for _mark in b"!#$%&*+/<=>@[\\]^_`{|}~":
    _KIND[_mark] = 5
_KIND[[32, 9, 11, 12, 13]] = 6
_KIND[10] = 7


def statistics(text: bytes) -> list[float]:
    """Numbers about one text; all shares are 0 for an empty one."""
    words = text.split()
    n, size = len(words), max(1, len(text))
    kinds = np.bincount(_KIND, weights=np.bincount(np.frombuffer(text, np.uint8), minlength=256), minlength=8)
    lines = [x for x in text.split(b"\n") if x]
    unique = len(set(words))
    common = Counter(words).most_common(2) if n else []
    pairs = len(set(zip(words, words[1:], strict=False)))
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    some = max(1, n)
    return [
        np.log1p(n), lengths.mean(), lengths.std(), unique / some, pairs / max(1, n - 1), same / some,
        (common[0][1] if common else 0) / some, (common[1][1] if len(common) > 1 else 0) / some,
        *(kinds[:8] / size), np.log1p(len(lines)), len(set(lines)) / max(1, len(lines)),
        n / max(1, len(lines)) / 100, float(np.log1p(kinds[5])),
    ]


def _matrix(texts) -> np.ndarray:
    rows = [statistics(x) for x in as_array(texts).cast(pa.binary()).to_pylist()]
    return np.asarray(rows, np.float64).reshape(len(rows), STATISTICS)


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, stats): one row per row of ``docs``."""
    schema = T.StructType([docs.select("doc_id").schema["doc_id"], T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def of(batches):
        for batch in batches:
            flat = pa.array(_matrix(batch.column(1)).ravel())
            stats = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1) * STATISTICS, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), stats], ["doc_id", "stats"])

    return docs.select("doc_id", "text").mapInArrow(of, schema)


@dataclass
class Quality:
    """A fitted model: bounded numbers only."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    phases: np.ndarray
    ridge: np.ndarray
    edges: np.ndarray  # raw score bins
    levels: np.ndarray  # calibrated score per bin

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -6, 6)
        return np.hstack([np.sqrt(2 / FOURIER) * np.cos(x @ self.weights + self.phases), np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.ridge

    def scores(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.edges, self.levels), 0, 1) if len(stats) else np.zeros(0)


def isotonic(count: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Non-decreasing levels closest to positive/count (pool adjacent violators); count must be positive."""
    blocks: list[list[float]] = []
    for n, p in zip(count, positive, strict=True):
        blocks.append([n, p, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n, p, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n, blocks[-1][1] + p, blocks[-1][2] + k]
    return np.concatenate([np.full(k, p / n) for n, p, k in blocks])


def _constant(level: float) -> Quality:
    return Quality(
        np.zeros(STATISTICS), np.ones(STATISTICS), np.zeros((STATISTICS, FOURIER)), np.zeros(FOURIER),
        np.zeros(FOURIER + 1), np.array([0.0, 1.0]), np.array([level, level]),
    )


def fit(stats: DataFrame, labels: DataFrame, ridge: float = 1e-3, width: float = 6.0, seed: int = 7) -> Quality:
    """Learn ``labels.quality`` from the statistics of every labelled row that is not held out.

    ``width`` is the kernel's; every learnable row takes part: two thirds in the normal
    equations, one third (by a hash of the id) in the calibration.
    """
    rows = store(
        stats.join(training_labels(labels, "quality"), "doc_id")
        .select("stats", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("aside"))
        .repartition(FIT_PARTITIONS),
        "quality-train",
    )
    share = rows.agg(F.count(F.lit(1)), F.avg("label"), F.sum(F.col("aside").cast("int"))).first()
    if not share[0] or share[1] in (0.0, 1.0) or share[2] in (0, share[0]):
        return _constant(share[1] if share[0] else 0.5)
    at = [F.col("stats")[i] for i in range(STATISTICS)]
    moments = rows.agg(*[F.avg(x) for x in at], *[F.stddev_pop(x) for x in at]).first()
    random = np.random.default_rng(seed)
    model = _constant(0.5)
    model.mean = np.array(moments[:STATISTICS], float)
    model.spread = np.maximum(np.array(moments[STATISTICS:], float), 1e-6)
    model.weights = random.normal(size=(STATISTICS, FOURIER)) / width
    model.phases = random.uniform(0, 2 * np.pi, FOURIER)

    def normal(batches):
        a, b = np.zeros((FOURIER + 1, FOURIER + 1)), np.zeros(FOURIER + 1)
        for batch in batches:
            z = model.fourier(_stats_of(batch.column(0)))
            a += z.T @ z
            b += z.T @ batch.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()]), pa.array([b.tobytes()])], ["a", "b"])

    sums = rows.filter(~F.col("aside")).select("stats", "label").coalesce(FIT_PARTITIONS)
    parts = sums.mapInArrow(normal, "a binary, b binary").collect()
    a = sum(np.frombuffer(p.a).reshape(FOURIER + 1, FOURIER + 1) for p in parts)
    b = sum(np.frombuffer(p.b) for p in parts)
    model.ridge = np.linalg.solve(a + ridge * np.eye(FOURIER + 1) * max(1.0, a[-1, -1] / 1000), b)

    def raw(batches):
        for batch in batches:
            bins = np.clip((model.raw(_stats_of(batch.column(0))) + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], ["bin", "label"])

    counts = (
        rows.filter("aside").select("stats", F.col("label").cast("double").alias("label"))
        .mapInArrow(raw, "bin long, label double")
        .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")).orderBy("bin").collect()
    )
    model.edges = np.array([(c.bin + 0.5) / BINS * 2 - 0.5 for c in counts])
    # Half a row of either label per bin edge keeps scores off 0 and 1 and lets them rank within a plateau.
    levels = isotonic(np.array([c.n for c in counts], float), np.array([c.p for c in counts], float))
    model.levels = 0.98 * levels + 0.02 * np.clip(model.edges, 0, 1)
    return model


def _stats_of(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, STATISTICS)


def score_stats(stats: DataFrame, model: Quality) -> DataFrame:
    """(doc_id, score) from stored statistics."""
    schema = T.StructType([stats.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_stats_of(batch.column(1))))], ["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(of, schema)


def keep_good(docs: DataFrame, model: Quality, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text scores ``least`` or more, all columns kept; no shuffle."""
    at = docs.columns.index("text")

    def of(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.scores(_matrix(batch.column(at))) >= least))

    return docs.mapInArrow(of, docs.schema)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    from merchlens.llm.common import table

    stats = store(features(table(spark, sf_dir, "documents")), "quality-stats")
    model = fit(stats, table(spark, sf_dir, "labels"))
    return score_stats(stats, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
