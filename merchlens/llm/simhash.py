"""SimHash near-dedup by anchor-point covering.

A fingerprint's 64 bits are cut into three blocks of 22, 21 and 21. Two fingerprints at
distance 4 or less differ in at most one bit of some block. The anchors of a block are the
words of a covering code: 15 bits by the perfect Hamming code (covering radius 1), the other
bits free. Each fingerprint is at home at its nearest anchor and a guest at every anchor
within covering radius plus one, so the home of either of two linked fingerprints meets the
other. Homes and guests of one anchor are compared; what a task finds goes out as stars
(each fingerprint with the least one it reaches there), so a group of n copies gives about n
rows, not n squared, and no link between components is lost. Stars are joined up by
alternating large and small stars, each round written to the shared folder.

Copies meet before all that: only different fingerprints are compared. Anchors with very many
homes are split by a hash; their guests go to every piece.

Defined cases: a null text counts as empty; texts without words have fingerprint zero and link
like any other; fewer words than a shingle make one shingle; rows without doc_id take part and
get the component's smallest id (null if it has none); repeated rows come back repeated; an
empty table gives an empty result; other columns are never read.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchlens.llm.common import as_array, store, table

WIDTH = 4
RADIUS = 4
SEED = 42
#: (first bit, bits) of each block; the lowest CODED bits of a block carry the Hamming code.
BLOCKS = ((0, 22), (22, 21), (43, 21))
CODED = 15
#: Homes of one anchor that a task holds at a time; at most MOST_SPLIT anchors can be above.
HOMES = 100_000
MOST_SPLIT = 10_000
PAIRS = 2_000_000
GUEST = "anchor long, piece int, home boolean, fp long"


def fingerprint(text: bytes, width: int = WIDTH) -> int:
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    n = len(words) - width + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 16384):
        bits = np.unpackbits(hashes[start : start + 16384].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: doc_id) and ``fp``, the fingerprint as a signed long, one row per row of ``docs``."""
    kept = ["doc_id"] if keep is None else keep
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("fp", T.LongType())])

    def of(batches):
        for batch in batches:
            texts = as_array(batch.column(batch.num_columns - 1)).cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(x, width) for x in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fps)], [*kept, "fp"])

    return docs.select(*kept, F.col("text").alias("_text")).mapInArrow(of, schema)


def _codes() -> tuple[np.ndarray, np.ndarray]:
    """For every 15-bit value: its nearest code word; all code words within distance 2 (-1: none)."""
    values = np.arange(1 << CODED)
    syndrome = np.zeros_like(values)
    for i in range(CODED):
        syndrome ^= np.where(values >> i & 1, i + 1, 0)
    nearest = np.where(syndrome > 0, values ^ (1 << np.maximum(syndrome - 1, 0)), values)
    near = np.full((1 << CODED, 8), -1)
    near[:, 0] = nearest
    filled = np.ones(1 << CODED, np.int64)
    for i in range(CODED):
        for j in range(i):
            other = values ^ (1 << i) ^ (1 << j)
            # A code word at distance 2 exists only beside values that are none themselves.
            hit = np.flatnonzero(syndrome == ((i + 1) ^ (j + 1)))
            near[hit, filled[hit]] = other[hit]
            filled[hit] += 1
    return nearest, near


def _members(fps: np.ndarray, tables, homes_only: bool = False):
    """Yield (anchor, home, fp) arrays of every block."""
    nearest, near = tables
    unsigned = fps.view(np.uint64)
    for block, (first, bits) in enumerate(BLOCKS):
        value = (unsigned >> np.uint64(first) & np.uint64((1 << bits) - 1)).astype(np.int64)
        coded, free = value & (1 << CODED) - 1, value >> CODED
        at = lambda code, rest: (block << 24) | (rest << CODED) | code  # noqa: B023, E731
        yield at(nearest[coded], free), np.ones(len(fps), bool), fps
        if homes_only:
            continue
        for k in range(1, near.shape[1]):
            some = near[coded, k] >= 0
            yield at(near[coded, k], free)[some], np.zeros(some.sum(), bool), fps[some]
        for i in range(bits - CODED):
            yield at(nearest[coded], free ^ (1 << i)), np.zeros(len(fps), bool), fps


def _anchors(distinct: DataFrame) -> DataFrame:
    """Each fingerprint at its home anchors and as guest, pieces of large anchors apart."""
    tables = _codes()

    def homes(batches):
        for batch in batches:
            for anchor, _, _ in _members(batch.column(0).to_numpy(), tables, homes_only=True):
                yield pa.RecordBatch.from_arrays([pa.array(anchor)], ["anchor"])

    counts = distinct.select("fp").mapInArrow(homes, "anchor long").groupBy("anchor").count()
    limit = max(HOMES, len(BLOCKS) * distinct.count() // MOST_SPLIT)
    large = {r["anchor"]: -(-r["count"] // limit) for r in counts.filter(F.col("count") > limit).collect()}
    keys = np.array(sorted(large), np.int64)
    pieces = np.array([large[k] for k in sorted(large)], np.int64)

    def all_of(batches):
        for batch in batches:
            for anchor, home, fp in _members(batch.column(0).to_numpy(), tables):
                split = np.ones(len(anchor), np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, anchor), len(keys) - 1)
                    split = np.where(keys[at] == anchor, pieces[at], 1)
                row = np.repeat(np.arange(len(anchor)), np.where(home, 1, split))
                piece = np.arange(len(row)) - np.repeat(np.cumsum(np.where(home, 1, split)) - np.where(home, 1, split), np.where(home, 1, split))
                own = (fp.view(np.uint64) % np.uint64(1_000_003)).astype(np.int64) % split
                extra = (home & (split > 1))[row]
                piece = np.where(extra, own[row], piece)
                yield _rows(anchor[row], piece, home[row], fp[row])
                if extra.any():  # a home is also a guest in the other pieces
                    for k in range(1, int(split.max())):
                        more = home & (split > k)
                        yield _rows(anchor[more], (own[more] + k) % split[more], np.zeros(more.sum(), bool), fp[more])

    return distinct.select("fp").mapInArrow(all_of, GUEST)


def _rows(anchor, piece, home, fp):
    return pa.RecordBatch.from_arrays(
        [pa.array(anchor, pa.int64()), pa.array(piece.astype(np.int32)), pa.array(home), pa.array(fp, pa.int64())],
        ["anchor", "piece", "home", "fp"],
    )


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each end of the given links but the least of its component, with that least one."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def _compare(homes: tuple[np.ndarray, np.ndarray], guests: tuple[np.ndarray, np.ndarray], radius: int):
    """Stars of all (home, guest) at most ``radius`` apart; both sides are (group, fp), homes sorted by group."""
    out: list[tuple[np.ndarray, np.ndarray]] = []
    first = np.searchsorted(homes[0], guests[0], "left")
    many = np.searchsorted(homes[0], guests[0], "right") - first
    total = np.concatenate([[0], np.cumsum(many)])
    start = 0
    while start < len(many):
        end = max(start + 1, int(np.searchsorted(total, total[start] + PAIRS, "right")) - 1)
        n = many[start:end]
        g = np.repeat(np.arange(start, end), n)
        h = np.arange(len(g)) - np.repeat(total[start:end] - total[start], n) + first[g]
        a, b = homes[1][h], guests[1][g]
        close = (np.bitwise_count((a ^ b).view(np.uint64)) <= radius) & (a != b)
        if close.any():
            out.append(stars(a[close], b[close]))
            if sum(len(x) for x, _ in out) > PAIRS:
                out = [stars(np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out]))]
        start = end
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return stars(np.concatenate([x for x, _ in out]), np.concatenate([y for _, y in out]))


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): stars over all fingerprints of ``distinct`` (column fp, no repeats) within ``radius`` of each other."""
    if radius // len(BLOCKS) > 1:
        raise ValueError(f"three blocks guarantee a radius of {2 * len(BLOCKS) - 1} at most")

    def compare(batches):
        held: list[np.ndarray] = []
        rows = 0

        def ready(last: bool):
            nonlocal held, rows
            group, home, fp = (np.concatenate(x) for x in zip(*held, strict=True))
            cut = len(group) if last else int(np.searchsorted(group, group[-1], "left"))
            if not last and cut == 0:  # one large group: its homes came first and stay, its guests are done with
                cut = int(home.sum())
                if cut == len(group):  # still homes
                    held = [(group, home, fp)]
                    return None
                pair = _compare((group[:cut], fp[:cut]), (group[cut:], fp[cut:]), radius)
                held, rows = [(group[:cut], home[:cut], fp[:cut])], cut
                return pair
            pair = _compare((group[:cut][home[:cut]], fp[:cut][home[:cut]]), (group[:cut], fp[:cut]), radius)
            held, rows = [(group[cut:], home[cut:], fp[cut:])], len(group) - cut
            return pair

        def edges(pair):
            return pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["u", "v"])

        target = 200_000
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.column(0).to_numpy() * 2**24 + batch.column(1).to_numpy()
            held.append((group, batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()))
            rows += batch.num_rows
            if rows >= target:
                if (pair := ready(False)) is not None and len(pair[0]):
                    yield edges(pair)
                target = rows + 200_000
        if rows:
            pair = ready(True)
            if len(pair[0]):
                yield edges(pair)

    return (
        _anchors(distinct).repartition("anchor", "piece")
        .sortWithinPartitions("anchor", "piece", F.col("home").desc())
        .mapInArrow(compare, "u long, v long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node each node of ``edges`` (u, v) reaches; both directions count."""
    def oriented(df):
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def state(df):
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())

    now = store(oriented(edges), "links")
    before = state(now)
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(oriented(large), "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        now = store(oriented(small), "small-star")
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for every fingerprint of ``marked`` (doc_id, fp).

    ``root`` tells components apart, ``component_id`` is the smallest doc_id in it.
    """
    distinct = store(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = components(links(distinct, radius))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    placed = store(placed, "placed")
    # Most components are single fingerprints; only the others need a second look.
    linked = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return placed.join(linked, "root").select("fp", "root", "component_id")


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row of each group of near copies stays, that with the smallest doc_id; all columns are kept.

    Of rows that repeat that id one stays, the least by hash of its text. A group without ids keeps one row likewise.
    """
    keyed = docs.select("doc_id", text_key(docs).alias("_key"), "text")
    marked = store(fingerprints(keyed, width, ["doc_id", "_key"]), "simhash")
    group = near_duplicates(marked, radius)
    return one_of_each(docs, marked.join(group, "fp").select("doc_id", "_key", "root"))


def text_key(docs: DataFrame) -> Column:
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def one_of_each(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """One row of ``docs`` for every root of ``placed`` (doc_id, _key of the text, root; a row per row of ``docs``)."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("_id"), "_key")).alias("_first")
    # An id and a text tell one row from all others unless the row is repeated.
    many = placed.groupBy("root", "doc_id", "_key").agg(F.count(F.lit(1)).alias("_many"))
    winners = store(
        many.groupBy("root").agg(first, F.min_by("_many", F.struct(F.col("doc_id").isNull(), "doc_id", "_key")).alias("_many"))
        .select("_first._id", "_first._key", "_many"), "winners",
    )
    # Kept rows grow with the corpus: the same join at every size, hashed on their side so that texts need no sort.
    columns = docs.columns
    kept = docs.join(
        winners.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(winners["_id"]) & (text_key(docs) == winners["_key"])
    )
    single = kept.filter("_many = 1").select(*[docs[c] for c in columns])
    if winners.filter("_many > 1").isEmpty():
        return single
    repeated = kept.filter("_many > 1").select("_id", "_key", F.struct(*[docs[c] for c in columns]).alias("_row"))
    return single.unionByName(repeated.groupBy("_id", "_key").agg(F.min("_row").alias("_row")).select("_row.*"))


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    marked = store(fingerprints(table(spark, sf_dir, "documents")), "simhash")
    group = near_duplicates(marked)
    return marked.join(group, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
