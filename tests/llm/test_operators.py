"""Every operator against a brute-force version, and on nulls, empty, long, tied and repeated rows."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.compare import rows_of
from merchlens.llm import decontaminate, licenses, mixture, neighbours, packing, quality, secrets, simhash, toxicity, warc
from merchlens.llm.common import held_out, split_words, table
from merchlens.llm.registry import ORACLE, QUERIES
from tests.llm.helpers import LONG, TEXTS, documents

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


def empty(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def con(folder):
    from checks.compare import connect

    connection = connect(folder)
    yield connection
    connection.close()


def test_words_are_split_at_ascii_space_only():
    codes, offsets, words = split_words(pa.array(["A b c", "", None, " x\x0by "]))
    assert [words[c].as_py() for c in codes] == ["a", "b c", "x", "y"] and offsets.tolist() == [0, 2, 2, 2, 4]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    cursor = con.execute(ORACLE[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


# ---- archives


PAGES = "page_id long, url string, html string, payload string, revisit string"


def test_archives_round_trip(spark, tmp_path):
    def page(seed):
        return "<p>é\r\n\r\n" + " ".join(f"word{x}" for x in np.random.default_rng(seed).integers(0, 500, 200)) + "</p>"

    rows = [(i, f"http://h/{i}", page(i % 350), "x", "y") for i in range(400)]
    rows += [(900, None, None, "x", "y"), (901, "http://a b\n", "", "x", "y"), (None, "u", "<p>0</p>", "x", "y"), (None, None, None, "x", "y"),
             (902, "u", "L" * 3_000_000, "x", "y"), (0, "http://h/0", rows[0][2], "x", "y")]
    pages = spark.createDataFrame(rows, PAGES)
    archives = warc.write_archives(warc.mark_revisits(pages).repartition(2), f"file://{tmp_path}/w")
    read = warc.read_archives(archives, payload=True).collect()
    first = {}
    for i, _, html, *_ in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    expected = Counter()
    for i, _, html, *_ in rows:
        text = html or ""
        revisit = text in first and i != first[text]
        expected[i, len(text.encode()), warc.digest(text.encode()), "revisit" if revisit else "response", first[text] if revisit else None] += 1
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read)
    assert got == expected
    assert {r.page_id: bytes(r.payload).decode() for r in read if r.record_type == "response" and r.page_id == 902} == {902: "L" * 3_000_000}
    files = list((tmp_path / "w").glob("*.warc.zst"))
    assert any(f.read_bytes()[:4] == warc.SKIPPABLE for f in files)


def test_broken_records_are_told(tmp_path):
    good = warc.record_bytes(1, "u", b"payload", None, False)
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (good.replace(b"WARC/1.1", b"WARC/9"), good[:-1], good.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"),
                good.replace(b"WARC-Date: ", b"Other: "), good.replace(b"Content-Length: ", b"Content-Length: x", 2)):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def test_cut_archive_and_small_payloads(spark, tmp_path):
    pages = spark.createDataFrame([(2, "u", "same", "", ""), (1, "v", "same", "", "")], PAGES)
    assert {r.page_id: r.revisit for r in warc.mark_revisits(pages, least=5).collect()} == {1: False, 2: False}
    archives = warc.write_archives(warc.mark_revisits(pages).coalesce(1), f"file://{tmp_path}/w")
    path = next((tmp_path / "w").glob("*.warc.zst"))
    path.write_bytes(path.read_bytes()[:-3])
    assert any(r.error for r in warc.read_archives(archives, strict=False).collect())
    assert warc.read_archives(warc.write_archives(warc.mark_revisits(pages.limit(0)), f"file://{tmp_path}/e")).count() == 0


# ---- mixture


def shared_out(sizes):
    """Targets as the rule reads: share, stop, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda x: [ord(c) for c in x]) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        left, all_ = total - sum(target.values()), sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / all_ > 2 * sizes[s]]
        for s in over or list(open_):
            target[s] = 2.0 * sizes[s] if over else left * weight[s] / all_
            open_.discard(s)
    return target


@pytest.mark.parametrize("case", ["edge", "table"])
def test_mixture(spark, folder, docs, case):
    df = docs if case == "edge" else table(spark, folder, "documents")
    rows = mixture.mix(df, ["doc_id", "text", "source"]).collect()
    assert len(rows) == df.count()
    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in rows:
        n = len(SPACE.findall(r.text or ""))
        assert r["size"] == n and 0 <= r.taken <= 2 * n and r.taken == r.copies * n
        sizes[r.source] += n
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], n)
    target = shared_out({**sizes, **{r.source: sizes[r.source] for r in rows}})
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert abs(taken[r.source] - r.target) <= largest[r.source]
    key = lambda x: sorted(map(str, x))
    assert key(rows) == key(mixture.mix(df, ["doc_id", "text", "source"]).collect())


def test_rates_are_the_tilted_ones(spark):
    sizes = spark.createDataFrame([("a", 10, 5), ("a", 100, 2), ("a", 1000, 1), ("b", 50, 4)], "source string, size long, n long")
    wanted = spark.createDataFrame([("a", 1250, 700.0), ("b", 200, 400.0)], "source string, source_size long, target double")
    rated = {(r.source, r["size"]): r.rate for r in mixture.rates(sizes, wanted).collect()}
    assert rated["b", 50] == 2.0
    assert 5 * 10 * rated["a", 10] + 200 * rated["a", 100] + 1000 * rated["a", 1000] == pytest.approx(700)
    odds = {s: np.log(rated["a", s] / (2 - rated["a", s])) / s for s in (10, 100, 1000)}
    assert odds[10] == pytest.approx(odds[1000], rel=1e-6) and odds[100] == pytest.approx(odds[1000], rel=1e-6)


def test_mixture_of_nothing_and_copies(spark, docs):
    assert mixture.mix(empty(spark)).count() == 0 and mixture.apply_mix(empty(spark)).count() == 0
    out = mixture.apply_mix(docs)
    assert out.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixture.mix(docs).collect() if r.doc_id in (6, 7, 10)}
    assert {i: out.filter(F.col("doc_id") == i).count() for i in copies} == copies


# ---- decontamination


ITEMS = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"),
         (2, "three little words"), (3, None), (4, ""), (5, "one two three four five six seven eight nine ten eleven twelve"), (None, "no id here at all my friend of mine")]


def brute_windows(text, item):
    w, b = (x.encode().lower().split() for x in (text or "", item or ""))
    if not b or not w:
        return 0.0
    width, n = min(5, len(b)), min(len(b), len(w))
    if not set(zip(*(w[i:] for i in range(width)), strict=False)) & set(zip(*(b[i:] for i in range(width)), strict=False)):
        return 0.0  # nothing in common
    return max(decontaminate.similarity(w[i : i + n], b, width) for i in range(len(w) - n + 1)) if n >= width else 0.0


def test_decontamination_equals_all_windows(spark):
    words = ITEMS[0][1].split()
    near = words[:9] + ["changed"] + words[9:]
    rows = [(1, "x y z " + ITEMS[0][1].upper() + " q", "s"), (2, " ".join(near), "s"), (3, " ".join(words[:12]), "s"),
            (4, "say three  LITTLE\nwords now", "s"), (5, "three little other words", "s"), (6, LONG + " " + ITEMS[4][1], "s"),
            (7, None, "s"), (8, "", "s"), (None, ITEMS[4][1], "s"), (9, " ".join(words[1:]), "s"), (9, " ".join(words[1:]), "s")]
    docs = documents(spark, rows)
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, doc_id string")
    got = Counter((r.doc_id, r.item_id, round(r.similarity, 9)) for r in decontaminate.contaminated(docs, items).collect())
    expected = Counter()
    for i, text, _ in rows:
        for item, b in ITEMS:
            if text is not LONG and (s := brute_windows(text if len(text or "") < 10_000 else text[-200:], b)) >= 0.8:
                expected[i, item, round(s, 9)] += 1
    assert got == expected and (1, 1, 1.0) in got
    clean = decontaminate.drop_contaminated(docs, items)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, *_ in rows) - Counter({i: n for i, n in Counter(
        i for i, t, _ in rows if any(brute_windows(t if len(t or "") < 10_000 else t[-200:], b) >= 0.8 for _, b in ITEMS)).items()})
    assert decontaminate.contaminated(empty(spark), items).count() == 0
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(rows)


def test_blocks_find_every_fingerprint_within_the_radius():
    index = decontaminate.Benchmark([(1, " ".join(f"w{i}" for i in range(30)))], 0.8, 16)
    _, _, fps, tables, _ = index.sizes[30]
    random = np.random.default_rng(1)
    for flips in range(17):
        for _ in range(50):
            other = fps[0] ^ np.uint64(sum(1 << int(b) for b in random.choice(64, flips, replace=False)))
            blocks = np.array([other]).view(np.uint8)
            assert any(tables[k][blocks[k]][0] for k in range(8))


# ---- packing


@pytest.mark.parametrize("length", [16, 2048])
def test_packing_loses_nothing(spark, docs, length):
    tokens = packing.Tokens.read(spark)
    encoder = tokens.encoder()
    rows = packing.pack(docs, tokens, length).collect()
    pieces = defaultdict(list)
    for r in rows:
        ids, places = np.frombuffer(bytes(r.ids), "<u2"), np.frombuffer(bytes(r.positions), "<u2")
        assert len(ids) == len(places) == length and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= length
        assert (ids[r.n_tokens :] == tokens.end).all()
        for doc, part, a, b in zip(r.doc_ids, r.parts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            pieces[doc].append((part, ids[a:b].tolist()))
    for doc in {i for i, *_ in TEXTS}:
        texts = [t or "" for i, t, _ in TEXTS if i == doc]
        whole = Counter(tuple(encoder.encode_ordinary(t)) + (tokens.end,) for t in texts)
        parts = sorted(pieces[doc], key=lambda x: x[0])
        assert sum(len(x) for _, x in parts) == sum(len(k) * n for k, n in whole.items())
        if len(texts) == 1:
            assert tuple(t for _, x in parts for t in x) == next(iter(whole))
    assert packing.pack(empty(spark), tokens).count() == 0


def test_words_are_encoded_as_in_the_whole_text(spark, folder):
    tokens = packing.Tokens.read(spark)
    texts = [r.text for r in table(spark, folder, "documents").select("text").collect()]
    texts += ["a  b", " a b", "a b ", "it's 'tis", "x\n y", "a  b", "tab\tx y", "1 2  3", ""]
    for text, ids in zip(texts, tokens.encode(pa.array(texts)), strict=True):
        assert ids.tolist() == tokens.encoder().encode_ordinary(text)


def test_best_fit_takes_the_fullest_row():
    random = np.random.default_rng(0)
    for length in (1, 7, 64, 100):
        sizes = random.integers(1, length + 1, 200)
        rows, free = packing.best_fit(sizes, length), []
        for size in sorted(sizes.tolist(), reverse=True):
            fits = [f for f in free if f >= size]
            if fits:
                free.remove(min(fits))
                free.append(min(fits) - size)
            else:
                free.append(length - size)
        assert sorted(length - int(sizes[r].sum()) for r in rows) == sorted(free)
        assert sorted(p for r in rows for p in r) == list(range(200))


def test_matrices_are_written(spark, docs, tmp_path):
    packed = packing.pack(docs, length=64)
    names = packing.write_matrices(packed, f"file://{tmp_path}/m").collect()
    assert sum(r.rows for r in names) == packed.count()
    assert sum((tmp_path / "m" / f"{r.name}.ids").stat().st_size for r in names) == sum(r.rows for r in names) * 64 * 2


# ---- neighbours


def brute_near(vectors, query, k):
    own = next(v for i, v in vectors if i == query)
    d = sorted((float(np.sqrt(((np.array(v) - own) ** 2).sum())), i) for i, v in vectors if i != query)
    return d[:k]


def test_neighbours_of_few_and_odd_vectors(spark):
    random = np.random.default_rng(4)
    good = [(i, random.normal(size=4).astype(np.float32).tolist()) for i in range(0, 300)]
    good += [(300, good[0][1]), (301, good[0][1])]
    odd = [(400, None), (500, [0.0] * 4), (600, [1.0, None, 0.0, 0.0]), (700, [float("nan"), 1.0, 1.0, 1.0]),
           (800, [float("inf"), 1.0, 1.0, 1.0]), (900, []), (1000, [1.0, 2.0]), (None, [1.0] * 4)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + odd], "vec_id long, embedding array<float>, score int, part string")
    got = neighbours.search(df, df.filter("vec_id % 100 = 0")).collect()
    wanted = [(i, np.array(v, np.float64)) for i, v in good]
    for query in (0, 100, 200, 300):
        mine = sorted((r["rank"], r.score, r.vec_id) for r in got if r.query_id == query)
        assert [m[0] for m in mine] == list(range(1, 11))
        best = brute_near(wanted, query, 10)
        assert len({m[2] for m in mine} & {b[1] for b in best}) >= 9
    assert {r.query_id for r in got} == {0, 100, 200, 300}
    first = sorted((r["rank"], r.vec_id) for r in got if r.query_id == 0)[:2]
    assert first == [(1, 300), (2, 301)]  # ties go to the smaller id
    few = df.filter("vec_id < 5")
    assert neighbours.search(few, few.filter("vec_id = 0")).count() == 4
    assert neighbours.search(df.limit(0), df.limit(0)).count() == 0


def test_recall(spark, folder):
    vectors = table(spark, folder, "embeddings")
    got = defaultdict(set)
    for r in QUERIES["op5_neighbours"](spark, folder).collect():
        got[r.query_id].add(r.vec_id)
    rows = [(r.vec_id, np.array(r.embedding, np.float64)) for r in vectors.collect()]
    hits = [len(got[q] & {i for _, i in brute_near(rows, q, 10)}) for q, _ in rows if q % 100 == 0]
    assert np.mean(hits) >= 9


def test_partitions_are_balanced_and_follow_the_graph():
    random = np.random.default_rng(0)
    points = np.concatenate([random.normal(size=(100, 8)) + 20 * np.eye(8)[c] for c in range(8)])
    graph = neighbours.nearest(points, 10)
    part = neighbours.balanced_partitions(graph, 8)
    assert np.bincount(part).max() <= 1.1 * 100 + 1
    assert (part[graph] == part[:, None]).mean() > 0.7


# ---- quality


def test_quality_learns_and_scores_every_row(spark, folder, docs):
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    rows = QUERIES["op6_quality"](spark, folder).collect()
    assert len(rows) == table(spark, folder, "documents").count() and all(0 <= r.score <= 1 for r in rows)
    known = [(labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = [s for y, s in known if y], [s for y, s in known if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(quality.features(docs), none)
    assert {r.score for r in quality.score_stats(quality.features(docs), model).collect()} == {0.5}
    assert quality.keep_good(docs, model).columns == docs.columns
    assert quality.features(empty(spark)).count() == 0


def test_isotonic():
    assert quality.isotonic(np.array([1.0, 1, 2, 1]), np.array([0.0, 1, 0, 1])).tolist() == pytest.approx([0, 1 / 3, 1 / 3, 1])


def test_held_out(spark):
    import zlib

    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
    assert spark.createDataFrame([(None,)], "i long").select(held_out(F.col("i"))).first()[0] is False


# ---- licenses


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_licenses(spark, docs):
    noise = " ".join(f"n{i}" for i in range(500))
    gpl = "This work is licensed under the GNU General Public License, version 3."
    rows = [*TEXTS, (20, f"{noise} Released under the MIT License. {noise}", "s"), (21, f"x {gpl} {gpl}", "s"),
            (22, "Apache license; mit-license, General  PUBLIC\nLicense", "s"), (23, f"{noise}\nLicensed under CC BY-NC 4.0.", "s"),
            (24, "Licensed under CC BY 4.0.", "s"), (25, "aİ mit license", "s")]
    df = documents(spark, rows)
    for r, (i, text, _) in zip(sorted(licenses.scan(df).collect(), key=lambda r: (str(r.doc_id), r.n_words)),
                               sorted(rows, key=lambda x: (str(x[0]), len(WORD.findall((x[1] or "").translate(FOLD))))), strict=True):
        words = WORD.findall((text or "").translate(FOLD))
        base = sorted((k, label) for p, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split())
        assert (r.doc_id, r.n_words, [(b.start, b.label) for b in r.base]) == (i, len(words), base)
        found = set()
        for t, (label, template) in enumerate(licenses.TEMPLATES):
            parts = template.split()
            for b in range(max(1, -(-len(words) // len(parts)))):
                block = set(words[b * len(parts) : (b + 2) * len(parts)])
                if len(block & set(parts)) >= 0.9 * len(set(parts)) - 1e-9:
                    found.add((t, label, b * len(parts)))
        assert {(m.template, m.label, m.start) for m in r.matches} == found
    assert licenses.scan(empty(spark)).count() == 0


# ---- secrets


def test_secrets(spark):
    random = np.random.default_rng(2)
    hexes = ["".join(random.choice(list("0123456789abcdef"), 40)) for _ in range(60)]
    keys = ["AKIA" + "".join(random.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), 16)) for _ in range(60)]
    rows = [(i, f'é\U0001f600 Token = "{h}" and {k} end', "s") for i, (h, k) in enumerate(zip(hexes, keys, strict=True))]
    rows += [(100, None, "s"), (101, "", "s"), (None, "password: short", "s"), (102, "secret=token=abcdefgh12 AKIA123", "s"), (103, "APİKEY=abcdefghijk api_key='abcdefghijk'", "s"),
             (104, "plain longwordlongwordlong words", "s"), (105, f"id {hexes[0][:31]}", "s"), (106, LONG, "s"), (106, LONG, "s")]
    found = secrets.find(documents(spark, rows))
    scored = secrets.formats(found, secrets.learn(found)).collect()
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = {i: t or "" for i, t, _ in rows}
    for r in scored:
        text = texts[r.doc_id]
        base = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 8]
        base += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        base += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        base.sort(key=lambda x: (x[1], secrets.KINDS.index(x[0])))
        assert [(s.kind, s.start, s.end) for s in r.base] == base
    added = {r.doc_id: [texts[r.doc_id][s.start : s.end] for s in r.added] for r in scored}
    assert added[105] == [hexes[0][:31]] and added[104] == [] and added[106] == []
    assert secrets.find(empty(spark)).count() == 0 and secrets.learn(secrets.find(empty(spark))) == {}


def test_op8_digests(spark, folder):
    for r in QUERIES["op8_secrets"](spark, folder).collect():
        base = ",".join(s for s in r.spans.split(",") if s and not s.startswith("format"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256


def test_automaton_tells_formats_apart():
    random = np.random.default_rng(3)
    learned = secrets.Automaton(["".join(random.choice(list("0123456789abcdef"), 32)) for _ in range(300)])
    assert learned.gain("0a1b2c3d4e5f60718293a4b5c6d7e8f9") > learned.gain("thequickbrownfoxjumpsoverlazydog") + 20


# ---- toxicity


def test_toxicity(spark):
    random = np.random.default_rng(6)
    plain = [f"w{i}" for i in range(300)]

    def text(toxic):
        words = [str(w) for w in random.choice(plain, 40)]
        for _ in range(toxic):
            words[random.integers(0, 40)] = str(random.choice(["nasty", "vileword", "vilething", "vilestuff"]))
        return " ".join(words) + "."

    rows, labels = [], []
    for i in range(600):
        toxic = 3 * (i % 4 == 0)
        rows.append((i, text(toxic), "s"))
        labels.append((i, int(bool(toxic))))
    rows += [(1000, "calm text w1 w2", "s"), (1001, "so nasty and w3 nasty vilenew words", "s"), (1002, None, "s"), (1003, "", "s"), (None, LONG, "s")]
    df = documents(spark, rows)
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    field = toxicity.fit(df, known)
    scored = {r.doc_id: r for r in toxicity.score(df, field).collect()}
    assert scored[1001].score >= 0.7 and max(scored[i].score for i in (1000, 1002, 1003, None)) < 0.5
    whole = dict((i, t) for i, t, _ in rows)
    assert {whole[1001][s.start : s.end] for s in scored[1001].spans} >= {"nasty"}
    truth = [(y, scored[i].score >= 0.7) for i, y in labels]
    assert np.mean([a == b for a, b in truth]) > 0.97
    assert {r.score for r in toxicity.score(df, toxicity.fit(df, known.filter("toxic = 0"))).collect()} == {0.0}
    assert toxicity.score(empty(spark), field).count() == 0


def test_marginals_equal_enumeration():
    field = toxicity.Field()
    field.turns = np.array([[0.3, -0.7], [0.2, 1.1]])
    score = np.array([0.5, -1.0, 2.0, -0.3, 0.9])
    starts, sizes = np.array([0, 3]), np.array([3, 2])
    p, expected = field.marginals(score, starts, sizes, pairs=True)
    total = np.zeros((2, 2))
    for a, n in zip(starts, sizes, strict=True):
        weights = {}
        for number in range(2**n):
            y = [number >> k & 1 for k in range(n)]
            weights[tuple(y)] = np.exp(sum(s * b for s, b in zip(score[a : a + n], y, strict=True)) + sum(field.turns[u, v] for u, v in zip(y, y[1:])))
        z = sum(weights.values())
        for k in range(n):
            assert p[a + k] == pytest.approx(sum(w for y, w in weights.items() if y[k]) / z)
        for y, w in weights.items():
            for u, v in zip(y, y[1:]):
                total[u, v] += w / z
    assert expected == pytest.approx(total)


# ---- near copies


def fingerprint(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps, radius=4):
    """Component number of every fingerprint, by comparing all."""
    fps = np.array(sorted(set(fps)), np.uint64)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(fps ^ f) <= radius):
            root[max(find(i), find(j))] = min(find(i), find(j))
    return {int(f): find(i) for i, f in enumerate(fps)}


def test_near_copies_equal_all_pairs(spark, folder, docs):
    for df in (docs, table(spark, folder, "documents").select("doc_id", "text", F.lit("x").alias("fp"))):
        rows = df.collect()
        marked = simhash.fingerprints(df)
        got = marked.join(simhash.near_duplicates(marked), "fp").collect()
        of = classes([fingerprint(r.text) for r in rows])
        least = {}
        for r in rows:
            c = of[fingerprint(r.text)]
            if r.doc_id is not None:
                least[c] = min(r.doc_id, least.get(c, r.doc_id))
        expected = Counter((r.doc_id, least.get(of[fingerprint(r.text)])) for r in rows)
        assert Counter((r.doc_id, r.component_id) for r in got) == expected
        kept = simhash.drop_near_duplicates(df, width=4)
        assert kept.columns == df.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
            [str(v) for v in set(least.values())] + ["None"] * len({of[fingerprint(r.text)] for r in rows} - set(least))
        )
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_links_of_dense_groups(spark, monkeypatch):
    """Chains of close fingerprints, with anchors of more homes than a task takes."""
    monkeypatch.setattr(simhash, "HOMES", 40)
    random = np.random.default_rng(8)
    values = set()
    for _ in range(6):
        base = int(random.integers(0, 2**63))
        for _ in range(150):
            values.add(base ^ sum(1 << int(b) for b in random.choice(64, random.integers(0, 5), replace=False)))
    values |= {int(x) for x in random.integers(0, 2**63, 500)}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.links(df)).collect()}
    of = classes([v % 2**64 for v in signed])
    groups, mine = defaultdict(set), defaultdict(set)
    for v in signed:
        groups[of[v % 2**64]].add(v)
        mine[roots.get(v, v)].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    roots = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert roots == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 160)}}


def test_every_anchor_word_is_a_code_word():
    nearest, near = simhash._codes()
    words = np.unique(nearest)
    assert len(words) == 2**11
    for value in (0, 1, 77, 32767, 12345):
        distance = np.bitwise_count((words ^ value).astype(np.uint64))
        assert distance.min() <= 1 and set(words[distance <= 2]) == {x for x in near[value] if x >= 0}
