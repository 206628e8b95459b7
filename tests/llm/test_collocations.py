"""Phrases against brute force; the query itself is compared with SQL."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from merchlens.llm import collocations
from tests.llm.helpers import documents


def brute(rows, least, share=50, first=2000):
    """``rows``: (lang, text)."""
    counts, out = defaultdict(Counter), []
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]", piece) if w]
            for size in (1, 2, 3):
                counts[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        longer: dict = {}
        for p, v in f.items():
            if len(p) == 3 and v >= least:
                for part in (p[:2], p[1:]):
                    longer[part] = max(v, longer.get(part, 0))
        found = []
        for p, a in f.items():
            if len(p) == 1 or a < least or 100 * longer.get(p, -1) >= share * a:
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def made(seed, many):
    random, rows = np.random.default_rng(seed), []
    words = [*"abcdefg", "New", "york", "CITY", "é", "上海", " x", "İ"]
    for k in range(many):
        text = "".join(random.choice(words) + random.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", " New york CITY "]) for _ in range(random.integers(0, 60)))
        rows.append((k, text, ["en", None, "und", "de"][k % 4]))
    return rows + [(900, None, "en"), (901, "", None), (902, " \t. ,\r\x0b", "xx"), (903, "a a a a", "en"), (903, "a a a a", "en")]


@pytest.mark.parametrize("size", [300, 12 << 20])
def test_phrases_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", size)
    rows = made(1, 150)
    docs = documents(spark, [(i, t, "s") for i, t, _ in rows]).drop("lang")
    langs = spark.createDataFrame([(i, lang) for i, _, lang in dict.fromkeys((i, "", lang) for i, _, lang in rows)], "doc_id long, lang string")
    # Columns named like those used inside.
    docs = docs.join(langs, "doc_id").withColumns({"word": F.lit(1), "chunk": F.lit(2), "f": F.lit(3), "rank": F.lit(4), "id": F.lit(5)})
    assert rows_of(collocations.collocations(docs, least=4)) == brute([(lang, t) for _, t, lang in rows], 4)


def test_the_first_of_many(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SPREAD", 3)
    rows = made(2, 80)
    docs = spark.createDataFrame([(t, lang) for _, t, lang in rows], "text string, lang string")
    assert rows_of(collocations.collocations(docs, least=2, first=7)) == brute([(lang, t) for _, t, lang in rows], 2, first=7)


def test_nothing(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(empty).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None), ("one", "en")], "text string, lang string")).collect() == []


@pytest.mark.parametrize("dense", [0.0, 0.2, 9.0])
def test_tiles_count_every_pair(monkeypatch, dense):
    monkeypatch.setattr(collocations, "TILE", 8)
    monkeypatch.setattr(collocations, "DENSE", dense)
    monkeypatch.setattr(collocations, "BLOCK_PAIRS", 700)
    random = np.random.default_rng(3)
    i, j = random.zipf(1.3, 3000) % 90, random.zipf(1.3, 3000) % 5000
    got = Counter()
    for a, b, n in zip(*map(np.ndarray.tolist, collocations.count_pairs(i, j)), strict=True):
        got[a, b] += n
    assert got == Counter(zip(i.tolist(), j.tolist(), strict=True))
    assert all(len(x) == 0 for x in collocations.count_pairs(np.zeros(0, int), np.zeros(0, int)))


def test_different_pairs_of_blocks_are_merged(monkeypatch):
    monkeypatch.setattr(collocations, "BLOCK_PAIRS", 5)
    ids = np.array([3, 1, 3, 1, -1, 3, 1, 3, 1, 2, -1, 2, 3, 1, 0])
    i, j, n, which = collocations.different_pairs(ids)
    pairs = list(zip(i.tolist(), j.tolist(), strict=True))
    assert dict(zip(pairs, n.tolist(), strict=True)) == Counter((a, b) for a, b in zip(ids[:-1].tolist(), ids[1:].tolist(), strict=True) if a >= 0 and b >= 0)
    assert len(set(pairs)) == len(pairs)
    for at, k in enumerate(which.tolist()):
        assert (k < 0) == (min(ids[at : at + 2]) < 0) and (k < 0 or pairs[k] == tuple(ids[at : at + 2].tolist()))


@pytest.mark.parametrize("long", [0, 1 << 13])
def test_packed_numbers_come_back(monkeypatch, long):
    monkeypatch.setattr(collocations, "LONG", long)
    random = np.random.default_rng(5)
    for size in (0, 1, 300, 5000):
        first = np.sort(random.integers(0, 1 << 40, size))
        columns = [first, random.integers(0, 300, size), np.zeros(size, int), random.integers(0, 1 << 62, size)]
        assert np.array_equal(collocations.unpack(collocations.pack(*columns, ordered=True), ordered=True), np.stack(columns))
        assert np.array_equal(collocations.unpack(collocations.pack(*columns[::-1])), np.stack(columns[::-1]))


@pytest.mark.parametrize("buckets", [1, 7, 500])
def test_buckets_sum_and_tell_every_chunk(monkeypatch, buckets):
    monkeypatch.setattr(collocations, "LONG", 200)
    random, sent, total = np.random.default_rng(6), [], Counter()
    for chunk in range(4):
        i, j, n = collocations.different_pairs(random.zipf(1.4, 900) % 50)[:3]
        total.update({(a, b): c for a, b, c in zip(i.tolist(), j.tolist(), n.tolist(), strict=True)})
        order, _, cuts = collocations.dealt(buckets, i, j)
        bucket, data = collocations.parcels(buckets, n, i, j)
        sent += [(b, chunk, d, i[order][a:z], j[order][a:z]) for b, d, a, z in zip(bucket, data, cuts[:-1], cuts[1:], strict=True)]
    got = {}
    for bucket in {b for b, *_ in sent}:
        own = [x for x in sent if x[0] == bucket]
        keys, f, which, ends = collocations.summed(pa.chunked_array([pa.array([x[2] for x in own])]))
        got |= {(a, b): c for a, b, c in zip(*keys.tolist(), f.tolist(), strict=True)}
        for (_, _, _, i, j), told in zip(own, np.split(f[which], ends[:-1]), strict=True):
            assert told.tolist() == [total[pair] for pair in zip(i.tolist(), j.tolist(), strict=True)]
    assert got == total


def test_small_buckets_give_the_same_phrases(spark, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 900)
    monkeypatch.setattr(collocations, "BUCKET_PAIRS", 40)
    rows = made(3, 80)
    docs = spark.createDataFrame([(t, lang) for _, t, lang in rows], "text string, lang string").repartition(3)
    assert rows_of(collocations.collocations(docs, least=3)) == brute([(lang, t) for _, t, lang in rows], 3)


def test_pairs_travel_packed(spark, tmp_path):
    """A chunk's pairs take a few bytes each on disk, not a row each."""
    ids = np.random.default_rng(7).zipf(1.2, 200_000) % 50_000
    many = len(set(zip(ids[:-1].tolist(), ids[1:].tolist(), strict=True)))
    sequences = spark.createDataFrame([(c, collocations.pack(ids + 1)) for c in range(3)], "chunk long, ids binary")
    sent = collocations.pairs_of_chunks(sequences, 5)
    assert sent.count() == 3 * 5
    assert sent.agg(F.sum(F.length("data"))).first()[0] < 3 * many * 6


def test_words(spark):
    assert collocations.split(pa.array(["A b.c\td", None, "", "e"])).to_pylist() == ["a", "b", "\n", "c", "d", "\n", "\n", "\n", "e", "\n"]


def test_scores_pass_64_bits(spark):
    big = 3 * 10**13
    row = spark.createDataFrame([(big, big + 7, big + 11)], "a long, l long, r long").select(collocations.score(F.col("a"), F.col("l"), F.col("r")))
    assert row.first()[0] == 10**6 * big * big // ((big + 7) * (big + 11))
