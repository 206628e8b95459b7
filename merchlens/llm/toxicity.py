"""Toxic spans by a linear-chain conditional random field.

Tokens have two labels. A token's features are its word, its prefixes of 4 to 8 characters and
its suffix of 3, hashed; neighbours act through the chain. Token labels for training come from
document labels: a word or prefix is toxic if it stands in many different contexts (the words
before and after) in toxic documents and in hardly any in clean ones; contexts, not documents,
are counted, so that copies of one document prove nothing. The field is fitted by AdaGrad on
chains of a bounded sample of labelled documents: at most ``SAMPLE`` toxic and ``CLEAN`` times as many
clean ones, those with the least hashes among texts of at most ``SAMPLE_BYTES``.

A chain is a sentence, cut every ``CHAIN`` tokens. Forward-backward runs over all chains of a
batch at a time; its marginals give spans (neighbouring tokens at 0.5 or more). The document's score is
a logistic curve over what its tokens' marginals add up to, fitted on a quarter of the sample that the
field did not see.

Defined cases: a null text is empty; an empty text has no evidence (its score is the least) and no span; repeated rows are
scored alike; null ids are carried; without labels of both kinds every score is 0; an empty table
gives an empty result; only the text is read.
"""

from __future__ import annotations

import re
import zlib
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchlens.llm.common import as_array, held_out, slices, split_words, table, training_labels

SAMPLE = 1000
#: Clean documents for each toxic one.
CLEAN = 4
SAMPLE_BYTES = 50_000
CHAIN = 64
BUCKETS = 1 << 18
PLAIN_CHAINS = 40_000
#: At least so many passes over the chains, and so many steps.
EPOCHS, STEPS = 4, 500
BATCH = 512
CHANCE, PURE = 0.05, 0.75
PREFIXES = (4, 5, 6, 7, 8)
FAINT = 0.2

_EDGE = b"\"'`.,;:!?()[]{}<>*&%$#@~|/\\_-+="
_STOPS = (b".", b"!", b"?", b".\"", b"!\"", b"?\"")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bare(word: bytes) -> str:
    """A lower-cased word without the marks around it."""
    return word.strip(_EDGE).decode("utf-8", "replace").lower()


def features_of(word: str) -> list[int]:
    names = [f"w{word}", f"s{word[-3:]}", *(f"{n}{word[:n]}" for n in PREFIXES)]
    return [zlib.crc32(n.encode()) % (BUCKETS - 1) + 1 for n in names] + [0]  # 0: every token has it


def log_add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.logaddexp(a, b)


class Field:
    """Weights of the features for label 1 against 0, and of the four transitions."""

    def __init__(self) -> None:
        self.weights = np.zeros(BUCKETS)
        self.turns = np.zeros((2, 2))
        self.trained = False
        self.level = (1.0, -2.0)

    def document(self, evidence: np.ndarray) -> np.ndarray:
        """Document scores; 0 without a trained field."""
        slope, offset = self.level
        return 1 / (1 + np.exp(-np.clip(slope * evidence + offset, -40, 40))) if self.trained else np.zeros(len(evidence))

    def marginals(self, score: np.ndarray, starts: np.ndarray, sizes: np.ndarray, pairs: bool = False):
        """P(label 1) of every token; ``score`` holds what its features say, chains lie one after the other.

        The odds of label 1 move along the chains, all chains at once. With ``pairs`` also the expected
        number of each transition.
        """
        ahead, behind = score.copy(), np.zeros_like(score)
        t = self.turns
        order = np.argsort(-sizes, kind="stable")
        first, many = starts[order], sizes[order]
        longest = int(many[0]) if len(many) else 0
        alive = [int(np.searchsorted(-many, -k, "left")) for k in range(longest)]  # chains longer than k
        for k in range(1, longest):
            at = first[: alive[k]] + k
            before = ahead[at - 1]
            ahead[at] += log_add(t[0, 1], t[1, 1] + before) - log_add(t[0, 0], t[1, 0] + before)
        for k in range(longest - 2, -1, -1):
            at = first[: alive[k + 1]] + k
            after = score[at + 1] + behind[at + 1]
            behind[at] = log_add(t[1, 0], t[1, 1] + after) - log_add(t[0, 0], t[0, 1] + after)
        p = 1 / (1 + np.exp(-np.clip(ahead + behind, -40, 40)))
        if not pairs:
            return p
        expected = np.zeros((2, 2))
        inner = np.ones(len(score), bool)
        inner[starts + sizes - 1] = False  # the last token of a chain starts no transition
        at = np.flatnonzero(inner)
        after = score[at + 1] + behind[at + 1]
        parts = [t[0, 0] + 0 * after, t[0, 1] + after, t[1, 0] + ahead[at], t[1, 1] + ahead[at] + after]
        parts = np.exp(np.array(parts) - np.max(parts, axis=0))
        expected[:] = (parts / parts.sum(axis=0)).sum(axis=1).reshape(2, 2)
        return p, expected

    def fit(self, at: np.ndarray, y: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int = 3, rate: float = 0.5) -> None:
        """AdaGrad on the log likelihood of chains: features (a row per token) and labels of their tokens."""
        random = np.random.default_rng(seed)
        heat, turn_heat = np.full(BUCKETS, 1e-8), np.full((2, 2), 1e-8)
        for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(1, len(starts))))):
            order = random.permutation(len(starts))
            for low in range(0, len(order), BATCH):
                some = order[low : low + BATCH]
                n = sizes[some]
                first = np.cumsum(n) - n
                tokens = np.arange(n.sum()) - np.repeat(first - starts[some], n)
                x, label = at[tokens], y[tokens]
                p, expected = self.marginals(self.weights[x].sum(axis=1), first, n, pairs=True)
                slope = np.bincount(x.ravel(), np.repeat(p - label, x.shape[1]), BUCKETS) / len(some) + 1e-6 * self.weights
                inner = np.ones(len(label), bool)
                inner[first + n - 1] = False
                inner = np.flatnonzero(inner)
                seen = np.bincount(2 * label[inner] + label[inner + 1], minlength=4).reshape(2, 2)
                turn = (expected - seen) / len(some)
                heat += slope**2
                turn_heat += turn**2
                self.weights -= rate * slope / np.sqrt(heat)
                self.turns -= 0.2 * turn / np.sqrt(turn_heat)
        self.trained = True


def chains_of(stop: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token and length of every chain: one starts where a text does, after a stop, and after CHAIN tokens without one."""
    cut = np.zeros(len(stop) + 1, bool)
    cut[offsets] = True
    cut[1:][stop] = True
    starts = np.flatnonzero(cut)
    sizes = np.diff(starts)
    pieces = -(-sizes // CHAIN)
    inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    begins = np.repeat(starts[:-1], pieces) + inner * CHAIN
    return begins, np.minimum(CHAIN, np.repeat(starts[1:], pieces) - begins)


def toxic_words(plain: list[str], codes: np.ndarray, offsets: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Which words of the vocabulary ``plain`` mark toxic texts, by themselves or by a prefix.

    If labels had nothing to do with a key (a word or a prefix), each of its contexts would be toxic with
    the share that toxic texts have of all words. A key marks if at least ``PURE`` of its contexts are toxic
    and not even ``CHANCE`` keys of all tried would come so far by chance (Chernoff bound).
    """
    toxic = np.repeat(labels, np.diff(offsets)).astype(bool)
    numbers: dict[str, int] = {}
    word = np.array([numbers.setdefault(w, len(numbers)) for w in plain], np.int64)[codes]
    edge = np.zeros(len(codes) + 1, bool)
    edge[offsets] = True
    before = np.where(edge[:-1], len(numbers), np.roll(word, 1))
    after = np.where(edge[1:], len(numbers), np.roll(word, -1))
    context = (before * (len(numbers) + 1) + after).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    share = min(0.9, max(toxic.mean(), 1e-3))
    marked = np.zeros(len(plain), bool)
    tables, tried = [], 0
    for n in (*PREFIXES, 0):
        keys: dict[str, int] = {}
        key_of = np.array([keys.setdefault(w[:n] if n else w, len(keys)) if len(w) > n else -1 for w in plain], np.int64)
        some = np.flatnonzero(key_of[codes] >= 0)
        key = key_of[codes[some]]
        _, first = np.unique(key.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) ^ context[some], return_index=True)
        bad = np.bincount(key[first], toxic[some][first], len(keys))
        every = np.bincount(key[first], minlength=len(keys))
        tried += int((every > 2).sum())
        tables.append((key_of, bad, every))
    for key_of, bad, every in tables:
        rate = np.clip(bad / np.maximum(every, 1), 1e-9, 1 - 1e-9)
        far = every * (rate * np.log(rate / share) + (1 - rate) * np.log((1 - rate) / (1 - share)))
        marks = (rate >= max(PURE, share)) & (far >= log(max(1, tried) / CHANCE))
        marked |= (key_of >= 0) & marks[np.maximum(key_of, 0)]
    return marked & np.array([bool(w) for w in plain], bool)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """Learn from at most ``sample`` toxic and ``CLEAN * sample`` clean documents, labelled and not held out."""
    known = training_labels(labels, "toxic")
    ids = None
    most = (sample * CLEAN, sample)
    for kind in (0, 1):
        # Half as many again, as some ids have no usable text.
        some = known.filter(F.col("label") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most[kind] * 3 // 2)
        ids = some if ids is None else ids.unionByName(some)
    texts = docs.select("doc_id", "text").filter(F.octet_length("text").between(1, SAMPLE_BYTES))
    rows = (
        texts.join(F.broadcast(ids), "doc_id").groupBy("text").agg(F.max("label").alias("label"), F.min("doc_id").alias("doc_id"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").collect()
    )
    of_kind = [[r for r in rows if r.label == k][: most[k]] for k in (0, 1)]
    field = Field()
    if not of_kind[0] or not of_kind[1]:
        return field
    # A quarter of the texts, spread over both kinds, is kept for the calibration of document scores.
    aside = of_kind[0][::4] + of_kind[1][::4]
    learn = [r for kind in of_kind for i, r in enumerate(kind) if i % 4]
    labels_of = np.array([r.label for r in learn], np.int64)
    codes, offsets, vocabulary = split_words(pa.array([r.text for r in learn], pa.string()), lower=False)
    if not len(codes):
        return field
    words = vocabulary.cast(pa.binary()).to_pylist()
    plain = [bare(w) for w in words]
    marked = toxic_words(plain, codes, offsets, labels_of)[codes]
    y = (marked & np.repeat(labels_of, np.diff(offsets)).astype(bool)).astype(np.int64)
    if not y.any():
        return field
    starts, sizes = chains_of(np.fromiter((w.endswith(_STOPS) for w in words), bool, len(words))[codes], offsets)
    # Chains with a marked word all take part, in clean texts as the hard cases; of the others a fixed number.
    total = np.concatenate([[0], np.cumsum(marked)])
    near = total[starts + sizes] > total[starts]
    plain_chains = np.random.default_rng(5).permutation(np.flatnonzero(~near))[:PLAIN_CHAINS]
    chosen = np.sort(np.concatenate([np.flatnonzero(near), plain_chains]))
    at = np.array([features_of(w) for w in plain], np.int32)
    tokens = np.arange(sizes[chosen].sum()) - np.repeat(np.cumsum(sizes[chosen]) - sizes[chosen] - starts[chosen], sizes[chosen])
    field.fit(at[codes[tokens]], y[tokens], np.cumsum(sizes[chosen]) - sizes[chosen], sizes[chosen])
    evidence, _ = evidence_of(pa.array([r.text for r in aside], pa.string()), field)
    field.level = calibrate(evidence, np.array([r.label for r in aside], float))
    return field


def calibrate(evidence: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (not below 0) and offset of a logistic curve, by Newton steps with a weak ridge."""
    x = np.stack([evidence, np.ones(len(evidence))], axis=1)
    w, ridge = np.array([1.0, -2.0]), np.diag([1e-2, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - ridge @ (w - [1.0, -2.0]))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return max(0.0, float(w[0])), float(w[1])


def evidence_of(texts: pa.Array, field: Field):
    """What the toxic tokens of each text add up to, and word-wise spans (first, end, p).

    Every different word adds -log(1 - p), 3 at most, p being its largest marginal, if that is at least
    ``FAINT``; it adds that again if it stands there more than once.
    """
    codes, offsets, vocabulary = split_words(texts, lower=False)
    n = len(offsets) - 1
    if not field.trained or not len(codes):
        return np.zeros(n), [[] for _ in range(n)]
    words = vocabulary.cast(pa.binary()).to_pylist()
    at = np.array([features_of(bare(w)) for w in words])
    score = field.weights[at].sum(axis=1)[codes]
    p = field.marginals(score, *chains_of(np.fromiter((w.endswith(_STOPS) for w in words), bool, len(words))[codes], offsets))
    some = np.flatnonzero(p >= FAINT)
    pair, index = np.unique((np.searchsorted(offsets, some, "right") - 1) * len(words) + codes[some], return_inverse=True)
    times = np.minimum(2, np.bincount(index, minlength=len(pair)))
    most = np.zeros(len(pair))
    np.maximum.at(most, index, p[some])
    total = np.bincount(pair // len(words), times * np.minimum(3.0, -np.log1p(-np.minimum(most, 1 - 1e-12))), n)
    spans: list[list] = [[] for _ in range(n)]
    marked = some[p[some] >= 0.5]
    for row, token in zip((np.searchsorted(offsets, marked, "right") - 1).tolist(), marked.tolist(), strict=True):
        place, own = token - int(offsets[row]), spans[row]
        if own and own[-1][1] == place:
            own[-1] = (own[-1][0], place + 1, max(own[-1][2], float(p[token])))
        else:
            own.append((place, place + 1, float(p[token])))
    return total, spans


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


def score(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, score, and toxic spans as code points of the text (end exclusive), one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(field)

    def of(batches):
        for batch in batches:
            for some in slices(batch, 2000):
                texts = as_array(some.column(1))
                total, found = evidence_of(texts, sent.value)
                top = sent.value.document(total)
                spans = []
                for row, own in enumerate(found):
                    places = [m.span() for m in _WORD.finditer(texts[row].as_py())] if own else []
                    spans.append([{"start": places[a][0], "end": places[b - 1][1], "probability": s} for a, b, s in own])
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(top), pa.array(spans, _SPANS)], ["doc_id", "score", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        of, f"doc_id {kind}, score double, spans array<struct<start:long,end:long,probability:double>>"
    )


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, field).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "spans"
    )
