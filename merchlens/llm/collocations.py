"""Phrase collocation mining by direct-address tiling.

A text is cut into pieces and words; what is counted are contiguous phrases of two and three words
within pieces, per language. Words that are too rare to stand in a frequent phrase only separate the
others. The rest get ids in order of frequency, so that frequent neighbours fall into few square
tiles of TILE x TILE pairs of ids. A block of pairs is dealt to its tiles; a tile with many pairs is
counted with a dense bincount over its cells, all others as sorted coordinates with their counts.
Frequent pairs are ranked anew by frequency, and a phrase of three words is a pair again: the rank of
its first two words and the id of the third, dealt to tiles and counted in the same way.

Texts are kept as chunks of one language: the different words and the places they take. Numbers reach
a chunk by joining its different words with the numbered ones, so nothing that grows with the corpus
is broadcast, a word that stands everywhere comes once a chunk, and no Python task holds more
than a chunk at a time.

Pairs and triples of a chunk are dealt to buckets by their hash and travel packed, one row a chunk and bucket
(columns of sorted ids, byte by byte, compressed); a bucket sums them and holds some BUCKET_PAIRS whatever the corpus.
What a bucket tells a chunk about its pairs are their counts, in the order the chunk sent them.

Scores are exact: floor(1,000,000 a^2 / (l r)) in decimals of 38 digits. The first rows of a language
are taken in pieces before the last ranking.

Defined cases: a null text is empty, a null language is ``und``; repeated rows count each; ids are not
read; words are told apart byte by byte after A-Z are lower-cased; a text without words adds nothing;
an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from merchlens.llm.common import as_array, store, table
from merchlens.llm.pieces import blocks

LEAST = 10
SHARE = 50
FIRST = 2000
SCALE = 1_000_000
#: Ids on a side of a tile; a tile with this share of its cells in pairs is counted densely.
TILE = 1024
DENSE = 1 / 16
#: Text bytes of a chunk, and how many times that a task holds of all languages.
CHUNK_BYTES = 6 << 20
HELD = 4
#: Pairs that are dealt to tiles at a time, and those of a bucket, repeats within a chunk included.
BLOCK_PAIRS = 4_000_000
BUCKET_PAIRS = 4_000_000
#: Bytes from which packed numbers are compressed.
LONG = 1 << 13
#: Pieces of a language whose first rows are taken before the last ranking.
SPREAD = 256
BREAK = "\n"
_EXACT = "decimal(38,0)"
CHUNKS = "chunk long, lang string, n long, words array<string>, counts array<long>, codes binary"


def planes(*columns: np.ndarray) -> list[np.ndarray]:
    """The bytes of whole numbers from 0 on, lowest first, a row each; no more of them than the largest number has."""
    columns = [np.ascontiguousarray(c, "<i8") for c in columns]
    widths = [(int(c.max(initial=0)).bit_length() + 7) // 8 for c in columns]
    return [np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8)[:, :w].T) for c, w in zip(columns, widths, strict=True)]


def framed(parts: list[np.ndarray], start: int, end: int) -> bytes:
    """Numbers ``start`` to ``end`` of ``planes``. What is long is compressed; for short ones that would take longer than all the rest."""
    data = b"".join([p[:, start:end].tobytes() for p in parts])
    head = (end - start).to_bytes(8, "little") + bytes([len(data) >= LONG, len(parts), *[len(p) for p in parts]])
    return head + (pa.compress(data, "zstd", asbytes=True) if len(data) >= LONG else data)


def pack(*columns: np.ndarray, ordered: bool = False) -> bytes:
    """Whole numbers of equal length from 0 on; ``ordered``: the first column never falls."""
    first = np.diff(columns[0], prepend=0) if ordered else columns[0]
    return framed(planes(first, *columns[1:]), 0, len(first))


def unpack(data: bytes, ordered: bool = False) -> np.ndarray:
    """The columns of ``pack``, a row each."""
    size, widths = int.from_bytes(data[:8], "little"), data[10 : 10 + data[9]]
    start, out = 10 + len(widths), np.zeros((len(widths), size), "<i8")
    if data[8]:
        data, start = pa.decompress(data[start:], sum(widths) * size, "zstd", asbytes=True), 0
    for column, width in zip(out, widths, strict=True):
        planes = np.frombuffer(data, np.uint8, width * size, start).reshape(width, size)
        column.view(np.uint8).reshape(-1, 8)[:, :width] = planes.T
        start += width * size
    if ordered:
        out[0] = np.cumsum(out[0])
    return out


def split(texts: pa.Array) -> pa.Array:
    """The words of all ``texts`` in order, with BREAK where a piece or a text ends."""
    lower = pc.ascii_lower(as_array(texts))
    spaced = pc.replace_substring(pc.replace_substring_regex(lower, r"[.,;:!?\n-\r]+", f" {BREAK} "), "\t", " ")
    parts = pc.split_pattern(pc.binary_join_element_wise(spaced, BREAK, " "), " ").flatten()
    return parts.filter(pc.greater(pc.binary_length(parts), 0))


def chunks(docs: DataFrame) -> DataFrame:
    """``docs`` (lang, text) as chunks: ``codes`` (packed) are 1 and up for places in ``words``, 0 ends a piece."""
    def of(batches):
        held: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32

        def made(langs):
            nonlocal number
            for lang in langs:
                size.pop(lang)
                coded = pa.chunked_array([split(t) for t in held.pop(lang)], pa.string()).combine_chunks().dictionary_encode()
                if isinstance(coded, pa.ChunkedArray):
                    coded = coded.combine_chunks()
                words, codes = coded.dictionary, coded.indices.to_numpy()
                counts = np.bincount(codes, minlength=len(words))
                gap = pc.index(words, BREAK).as_py()
                codes = np.where(codes == gap, -1, codes - (codes > gap)).astype(np.int32)
                counts, words = np.delete(counts, gap), words.filter(pc.not_equal(words, BREAK))
                if not len(words):
                    continue
                rows = [[number], [lang], [int(counts.sum())], [words], [counts], [pack(codes + 1)]]
                types = [pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r, t) for r, t in zip(rows, types, strict=True)], ["chunk", "lang", "n", "words", "counts", "codes"]
                )
                number += 1

        for batch in batches:
            for some in blocks(batch, 1, CHUNK_BYTES // 4):
                langs = some.column(0).dictionary_encode()
                for code, lang in enumerate(langs.dictionary.to_pylist()):
                    texts = some.column(1).filter(pc.equal(langs.indices, code))
                    held.setdefault(lang, []).append(texts)
                    size[lang] = size.get(lang, 0) + (pc.sum(pc.binary_length(texts)).as_py() or 0)
                full = sum(size.values()) >= HELD * CHUNK_BYTES
                yield from made([lang for lang in sorted(held) if full or size[lang] >= CHUNK_BYTES])
        yield from made(sorted(held))

    return docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    ).mapInArrow(of, CHUNKS)


def numbered(counted: DataFrame, *order) -> DataFrame:
    """``counted`` with ``id``: its place in order of ``order`` (a total order), from 0, over all rows.

    Range partitions are sorted apart; the counts of the partitions before give the rest.
    """
    sorted_ = store(
        counted.sort(*order).withColumn("_at", F.monotonically_increasing_id())
        .withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(2**33 - 1)}), "numbered",
    )
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sorted_.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    parts = parts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    return store(
        sorted_.join(parts, "_part").withColumn("id", F.col("_at") + F.col("_before")).drop("_at", "_part", "_before"), "ids"
    )


def count_pairs(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different (left, right) and their counts: dense tiles by bincount, the others as sorted coordinates."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(left), BLOCK_PAIRS):
        i, j = left[start : start + BLOCK_PAIRS], right[start : start + BLOCK_PAIRS]
        across = int(j.max()) // TILE + 1
        tile, cell = i // TILE * across + j // TILE, i % TILE * TILE + j % TILE
        order = np.argsort(tile, kind="stable")
        tile, cell = tile[order], cell[order]
        cuts = np.flatnonzero(np.diff(tile, prepend=tile[0] - 1, append=tile[-1] + 1))
        full = np.diff(cuts) >= DENSE * TILE * TILE
        dense = np.zeros(len(tile), bool)
        for a, b in zip(cuts[:-1][full].tolist(), cuts[1:][full].tolist(), strict=True):
            dense[a:b] = True
            counts = np.bincount(cell[a:b], minlength=TILE * TILE)
            seen = np.flatnonzero(counts)
            found.append((tile[a] // across * TILE + seen // TILE, tile[a] % across * TILE + seen % TILE, counts[seen]))
        tile, cell = tile[~dense], cell[~dense]
        if len(tile):
            order = np.lexsort((cell, tile))
            tile, cell = tile[order], cell[order]
            first = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (cell[1:] != cell[:-1])]))
            counts = np.diff(np.append(first, len(tile)))
            tile, cell = tile[first], cell[first]
            found.append((tile // across * TILE + cell // TILE, tile % across * TILE + cell % TILE, counts))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    i, j, n = (np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True))
    if len(left) > BLOCK_PAIRS:  # the same pair in several blocks
        order = np.lexsort((j, i))
        i, j, n = i[order], j[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        i, j, n = i[first], j[first], np.add.reduceat(n, first)
    return i, j, n


def _looked_up(size: int, found: pa.Table) -> np.ndarray:
    """Ids by place; -1 where there is none."""
    out = np.full(size, -1)
    out[found.column("place").to_numpy()] = found.column("id").to_numpy()
    return out


def often(rows: DataFrame, key: list[str], least: int) -> DataFrame:
    """``rows`` whose ``key`` comes at least ``least`` times (the sum of ``n``, told in ``f``), in one shuffle.

    A key has one row a chunk at most, however often it comes.
    """
    return rows.withColumn("f", F.sum("n").over(Window.partitionBy(*key))).filter(F.col("f") >= least).drop("n")


def with_word_ids(chunked: DataFrame, frequent: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(chunk, ids, many): the ids of a chunk's words in order, packed, from 1; 0 stands for the end of a piece and for rare words."""
    places = frequent.join(vocabulary.select("lang", "word", "id"), ["lang", "word"]).select(F.col("chunk").alias("of"), "place", "id")

    def of(key, found, row):
        if not row.num_rows:
            return pa.table({"chunk": pa.array([], pa.int64()), "ids": pa.array([], pa.binary()), "many": pa.array([], pa.int64())})
        codes = unpack(row.column("codes")[0].as_py())[0] - 1
        ids = np.append(_looked_up(int(codes.max(initial=-1)) + 1, found), -1)[codes]
        ids = ids[(ids >= 0) | (np.append(-1, ids[:-1]) >= 0)]  # one break is enough
        return pa.table({"chunk": row.column("chunk"), "ids": pa.array([pack(ids + 1)], pa.binary()), "many": pa.array([len(ids)])})

    return places.groupBy("of").cogroup(chunked.select("chunk", "codes").groupBy("chunk")).applyInArrow(
        of, "chunk long, ids binary, many long"
    )


def different_pairs(ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different neighbours (i, j) in ``ids``, their counts, and for each place but the last which of them stands there (-1: none)."""
    good = (ids[:-1] >= 0) & (ids[1:] >= 0)
    i, j, n = count_pairs(ids[:-1][good], ids[1:][good])
    order = np.lexsort((j, i))
    i, j, n = i[order], j[order], n[order]
    which = np.full(max(0, len(ids) - 1), -1)
    if len(i):
        # Pairs as one number: the place of i among the different ones, then j.
        firsts, size = np.unique(i), int(ids.max()) + 1
        key = np.searchsorted(firsts, i) * size + j
        which[good] = np.searchsorted(key, np.searchsorted(firsts, ids[:-1][good]) * size + ids[1:][good])
    return i, j, n, which


def _ids(data: bytes) -> np.ndarray:
    return unpack(data)[0] - 1


def dealt(buckets: int, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``keys`` dealt to buckets by hash: an order that puts a bucket together, the buckets that have some, where each begins and the last ends."""
    mixed = np.zeros(len(keys[0]), np.uint64)
    for key in keys:
        mixed = (mixed ^ key.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    bucket = (mixed % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    return order, bucket[first], np.append(first, len(bucket))


def parcels(buckets: int, counts: np.ndarray, *keys: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Sorted ``keys`` and their ``counts`` packed by bucket, as by ``pack`` with ``ordered``."""
    order, bucket, cuts = dealt(buckets, *keys)
    first, *others = (c[order] for c in (*keys, counts))
    steps = np.diff(first, prepend=0)
    steps[cuts[:-1]] = first[cuts[:-1]]
    parts = planes(steps, *others)
    return bucket.tolist(), [framed(parts, a, b) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def summed(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the parcels of a bucket: its different keys (a row a column), their sums, which key stands where, and where each parcel ends."""
    rows = [unpack(data, ordered=True) for data in column.to_pylist()]
    ends = np.cumsum([r.shape[1] for r in rows])
    rows = np.concatenate(rows, axis=1)
    order = np.lexsort(rows[-2::-1])
    keys = rows[:-1, order]
    first = np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0))
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(first) - 1
    return keys[:, first], np.add.reduceat(rows[-1][order], np.flatnonzero(first)), which, ends


def pairs_of_chunks(sequences: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, data): the different neighbours of each chunk of ``sequences`` and their counts, packed."""
    def of(batches):
        for batch in batches:
            for chunk, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                i, j, n, _ = different_pairs(_ids(ids.as_py()))
                bucket, data = parcels(buckets, n, i, j)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int64()), pa.array([chunk] * len(bucket), pa.int64()), pa.array(data, pa.binary())],
                    ["bucket", "chunk", "data"],
                )

    return sequences.select("chunk", "ids").mapInArrow(of, "bucket long, chunk long, data binary")


def often_pairs(parcelled: DataFrame, least: int) -> DataFrame:
    """(bucket, chunk, data) of ``pairs_of_chunks``: for each of its pairs, in order, how often it comes in all, 0 for less than ``least``.

    A row without chunk holds the frequent pairs of a bucket and their counts.
    """
    def of(rows):
        keys, f, which, ends = summed(rows.column("data"))
        good = f >= least
        if not good.any():
            return pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()), "data": pa.array([], pa.binary())})
        told = np.where(good, f, 0)[which]
        starts = np.append(0, ends[:-1])
        some, parts = np.maximum.reduceat(told, starts) > 0, planes(told)
        data = [framed(parts, a, b) if x else None for x, a, b in zip(some.tolist(), starts.tolist(), ends.tolist(), strict=True)]
        data = pa.array([*data, pack(*keys[:, good], f[good], ordered=True)], pa.binary())
        bucket, chunk = rows.column("bucket").to_pylist(), rows.column("chunk").to_pylist()
        out = pa.table({"bucket": pa.array([*bucket, bucket[0]]), "chunk": pa.array([*chunk, None], pa.int64()), "data": data})
        return out.filter(pc.is_valid(data))

    return parcelled.groupBy("bucket").applyInArrow(of, "bucket long, chunk long, data binary")


def pairs_of(frequent: DataFrame) -> DataFrame:
    """(i, j, f): the frequent pairs that ``often_pairs`` tells of."""
    def of(batches):
        for batch in batches:
            for data in batch.column(0):
                columns = unpack(data.as_py(), ordered=True)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["i", "j", "f"])

    return frequent.filter(F.col("chunk").isNull()).select("data").mapInArrow(of, "i long, j long, f long")


def triples(sequences: DataFrame, frequent: DataFrame, buckets: int, least: int) -> DataFrame:
    """(i, j, k, a): how often a frequent pair stands before a third word, where the last two words are frequent together too; from ``least``.

    ``frequent``: what ``often_pairs`` tells of the pairs of ``pairs_of_chunks``. The frequent pairs of a chunk are
    ranked anew by how frequent they are in all, and with the third word dealt to tiles as words are.
    """
    def of(key, found, row):
        bucket, data = [], []
        if row.num_rows and found.num_rows:
            ids = _ids(row.column("ids")[0].as_py())
            first, second, _, which = different_pairs(ids)
            order, dealt_to, cuts = dealt(buckets, first, second)
            f = np.zeros(len(first), np.int64)
            for at, counts in zip(np.searchsorted(dealt_to, found.column("bucket").to_numpy()).tolist(), found.column("data"), strict=True):
                f[order[cuts[at] : cuts[at + 1]]] = unpack(counts.as_py())[0]
            place = np.flatnonzero(f)
            place = place[np.lexsort((place, -f[place]))]
            rank = np.full(len(first) + 1, -1)
            rank[place] = np.arange(len(place))
            at = rank[which]
            good = (at[:-1] >= 0) & (at[1:] >= 0)
            pair, k, n = count_pairs(at[:-1][good], ids[2:][good])
            i, j = first[place][pair], second[place][pair]
            order = np.lexsort((k, j, i))
            bucket, data = parcels(buckets, n[order], i[order], j[order], k[order])
        return pa.table({"bucket": pa.array(bucket, pa.int64()), "data": pa.array(data, pa.binary())})

    def in_all(rows):
        keys, a, _, _ = summed(rows.column("data"))
        return pa.table([*keys[:, a >= least], a[a >= least]], names=["i", "j", "k", "a"])

    told = frequent.filter(F.col("chunk").isNotNull()).select(F.col("chunk").alias("of"), "bucket", "data")
    counted = told.groupBy("of").cogroup(sequences.select("chunk", "ids").groupBy("chunk")).applyInArrow(of, "bucket long, data binary")
    return counted.groupBy("bucket").applyInArrow(in_all, "i long, j long, k long, a long")


def score(a, left, right):
    """floor(SCALE a^2 / (left right)), exactly; at most SCALE, since a part is as frequent as the whole."""
    exact = [c.cast("decimal(15,0)") for c in (a, left, right)]
    return F.call_function("div", exact[0] * exact[0] * F.lit(SCALE).cast("decimal(7,0)"), exact[1] * exact[2]).cast("long")


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, first: int = FIRST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first phrases of two and three words of each language of ``docs`` (lang, text)."""
    chunked = store(chunks(docs), "phrase-chunks")
    total = store(chunked.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-words")
    spread = chunked.select("chunk", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("place", "w"))
    spread = spread.select("chunk", "lang", "place", F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    frequent = store(often(spread, ["lang", "word"], least), "phrase-places")
    words = numbered(frequent.select("lang", "word", "f").distinct(), F.col("f").desc(), "lang", "word")
    sequences = store(with_word_ids(chunked, frequent, words), "phrase-ids")

    # More tasks than buckets would find nothing to do.
    many = sequences.agg(F.coalesce(F.sum("many"), F.lit(0))).first()[0]
    buckets = max(math.ceil(many / BUCKET_PAIRS), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    frequent = store(often_pairs(pairs_of_chunks(sequences, buckets), least), "phrase-pairs")
    pairs = pairs_of(frequent)
    three = triples(sequences, frequent, buckets, least)

    def word(name, *more):
        return words.select(F.col("id").alias(name), F.col("word").alias(f"{name}_word"), F.col("f").alias(f"{name}_f"), *more)

    named = store(
        pairs.join(word("i", "lang"), "i").join(word("j"), "j")
        .select("lang", "i", "j", "f", "i_f", "j_f", F.concat_ws(" ", "i_word", "j_word").alias("phrase")), "phrase-named",
    )
    head = named.select("i", "j", "lang", F.col("phrase").alias("_head"), F.col("f").alias("_head_f"), "i_f")
    tail = named.select(F.col("i").alias("j"), F.col("j").alias("k"), F.col("f").alias("_tail_f"), F.col("j_f").alias("k_f"))
    third = words.select(F.col("id").alias("k"), F.col("word").alias("_third"))
    three = three.join(head, ["i", "j"]).join(tail, ["j", "k"]).join(third, "k")
    early, late = score(F.col("a"), F.col("i_f"), F.col("_tail_f")), score(F.col("a"), F.col("_head_f"), F.col("k_f"))
    three = store(
        three.withColumns({"_early": early, "_late": late}).select(
            "lang", "i", "j", "k", F.concat_ws(" ", "_head", "_third").alias("phrase"), "a",
            F.when(F.col("_early") <= F.col("_late"), F.col("i_f")).otherwise(F.col("_head_f")).alias("l"),
            F.when(F.col("_early") <= F.col("_late"), F.col("_tail_f")).otherwise(F.col("k_f")).alias("r"),
            F.least("_early", "_late").alias("score"),
        ), "phrase-triples",
    )
    inner = F.explode(F.array(F.struct(F.col("i"), F.col("j")), F.struct(F.col("j").alias("i"), F.col("k").alias("j"))))
    longer = three.select(inner.alias("in"), "a").groupBy("in.i", "in.j").agg(F.max("a").alias("_most"))
    two = named.join(longer, ["i", "j"], "left").filter(F.coalesce(100 * F.col("_most") < share * F.col("f"), F.lit(True))).select(
        "lang", "phrase", F.col("f").alias("a"), F.col("i_f").alias("l"), F.col("j_f").alias("r"),
        score(F.col("f"), F.col("i_f"), F.col("j_f")).alias("score"),
    )
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    every = two.select(*columns).unionByName(three.select(*columns)).withColumn("_piece", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    some = every.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_piece").orderBy(*order))).filter(F.col("rank") <= first)
    # At most SPREAD * first rows of a language are left.
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.filter(F.col("rank") <= first).join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


# Single letters between A and Z are lower-cased apart from others; breaks become one character that no word holds.
OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, doc, unnest(string_split(
        regexp_replace(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A\x0B\x0C\x0D]', chr(10), 'g'), chr(10))) AS piece
    FROM (SELECT lang, coalesce(text, '') AS text, row_number() OVER () AS doc FROM documents)
),
words AS (
    SELECT lang, list_filter(string_split(replace(piece, chr(9), ' '), ' '), lambda x: x <> '') AS w FROM pieces
),
one AS (SELECT lang, x AS phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM words) GROUP BY 1, 2),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY 1),
grams AS (
    SELECT lang, 2 AS size, w[i] AS w1, w[i + 1] AS w2, NULL AS w3 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM words WHERE len(w) > 1)
    UNION ALL
    SELECT lang, 3, w[i], w[i + 1], w[i + 2] FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) > 2)
),
f AS (
    SELECT lang, size, w1, w2, w3, concat_ws(' ', w1, w2, w3) AS phrase, count(*) AS a
    FROM grams GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 10
),
cuts AS (
    SELECT f.lang, f.size, f.w1, f.w2, f.w3, f.phrase, f.a, 1 AS k, x.f AS l,
        CASE WHEN f.size = 2 THEN y.f ELSE p.a END AS r
    FROM f JOIN one x ON x.lang = f.lang AND x.phrase = f.w1
    LEFT JOIN one y ON f.size = 2 AND y.lang = f.lang AND y.phrase = f.w2
    LEFT JOIN f p ON f.size = 3 AND p.size = 2 AND p.lang = f.lang AND p.w1 = f.w2 AND p.w2 = f.w3
    UNION ALL
    SELECT f.lang, f.size, f.w1, f.w2, f.w3, f.phrase, f.a, 2, p.a, y.f
    FROM f JOIN f p ON p.size = 2 AND p.lang = f.lang AND p.w1 = f.w1 AND p.w2 = f.w2
    JOIN one y ON y.lang = f.lang AND y.phrase = f.w3
    WHERE f.size = 3
),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, size, phrase ORDER BY score, k) = 1),
longer AS (
    SELECT lang, w1, w2, max(a) AS most FROM (
        SELECT lang, w1, w2, a FROM f WHERE size = 3 UNION ALL SELECT lang, w2, w3, a FROM f WHERE size = 3) GROUP BY 1, 2, 3
),
kept AS (
    SELECT b.* FROM best b LEFT JOIN longer t ON b.size = 2 AND t.lang = b.lang AND t.w1 = b.w1 AND t.w2 = b.w2
    WHERE t.most IS NULL OR 100 * t.most < 50 * b.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
