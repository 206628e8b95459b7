"""The prefix table against the library, on the tables and on awkward texts."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from merchlens.llm import pieces
from merchlens.llm.common import table
from merchlens.llm.registry import QUERIES
from tests.llm.helpers import documents

PARTS = [*"ab ▁.,\n\t\x00éß上海\U0001f600theing<0x>/s\x7f­", "the", " of", "</s>", "<unk>", "<0x41>", "ation", "   ", "▁▁", "     "]


@pytest.fixture(scope="module")
def model():
    with open(pieces.VOCABULARY, "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PARTS), max_size=40).map("".join), min_size=1, max_size=5))
def test_any_text_is_encoded_as_by_the_library(model, library, texts):
    own = pieces.vocabulary(model)
    ids = own.encode(pa.array(texts))
    assert ids.to_pylist() == [library.encode(t, add_eos=True) for t in texts]
    assert own.decode(ids).to_pylist() == [library.decode(i) for i in ids.to_pylist()]


@settings(max_examples=300, deadline=None)
@given(ids=st.lists(st.sampled_from([0, 1, 2, 3, 70, 130, 150, 195, 200, 226, 259, 264, 28705, 29054]), max_size=12))
def test_any_ids_are_decoded_as_by_the_library(model, library, ids):
    assert pieces.vocabulary(model).decode(pa.array([ids, [2], ids], pa.list_(pa.int32()))).to_pylist() == [
        library.decode(ids), "", library.decode(ids)
    ]


def test_runs_and_long_texts(model, library):
    own, random = pieces.Pieces(model), np.random.default_rng(5)
    texts = [c * k for c in " a▁" for k in range(1, 70)] + ["x" * 100_000, " " * 50_000]
    texts.append("".join(random.choice(PARTS, 60_000)))
    texts.append("".join(random.choice(list("abcdef上海é\U0001f600"), 60_000)))
    assert own.encode(pa.array(texts)).to_pylist() == library.encode(texts, add_eos=True)


def test_a_vocabulary_that_is_not_cut_at_spaces_and_small_memories(model, library, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 50)
    monkeypatch.setattr(pieces, "KEPT_UNITS", 5)
    own, texts = pieces.Pieces(model), ["a text with  some words", "", None, " of the text", "some words"]
    expected = [library.encode(t or "", add_eos=True) for t in texts]
    assert own.encode(pa.array(texts)).to_pylist() == expected
    own.splits = False
    assert own.encode(pa.array(texts)).to_pylist() == expected


def test_other_vocabularies_are_refused(model):
    pieces.Pieces(model)
    space_off = model.replace(b"identity\x12\x00\x18\x01", b"identity\x12\x00\x18\x00")
    assert space_off != model
    with pytest.raises(ValueError, match="plain"):
        pieces.Pieces(space_off)


def test_blocks_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 9, None, "b" * 50, "", "c", "d"])], ["i", "t"])
    got = [b.column(0).to_pylist() for b in pieces.blocks(batch, 1, 10)]
    assert got == [[0, 1], [2], [3, 4, 5]]


def test_every_row_of_the_query(spark, folder, library):
    expected = []
    for r in table(spark, folder, "documents").collect():
        ids = library.encode(r.text or "", add_eos=True)
        expected.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, QUERIES["op11_pieces"](spark, folder).collect())) == sorted(expected)


def test_awkward_rows(spark, library):
    docs = documents(spark)
    got = pieces.decode(pieces.encode(docs)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    expected = [(r.doc_id, library.encode(r.text or "", add_eos=True)) for r in docs.collect()]
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(expected, key=key)
    assert all(r.decoded == library.decode(r.ids) for r in got)
    assert pieces.decode(pieces.encode(documents(spark, []))).collect() == []
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert pieces.decode(nothing).first().decoded == ""


def test_known_pairs_come_with_the_match_and_are_bounded(monkeypatch):
    with open(pieces.VOCABULARY, "rb") as file:
        made = pieces.Pieces(file.read())
    texts = pa.array(["some plain words, and others: Thlyouble onntshansh", "x 猫\U0001f408 xx", ""])
    want = made.encode(texts).to_pylist()
    assert made.kept == sum(map(len, made.pairs.values())) > 3
    monkeypatch.setattr(made, "_merged", None)  # nothing is tested twice
    made.units.clear()
    assert made.encode(texts).to_pylist() == want
    monkeypatch.undo()
    monkeypatch.setattr(pieces, "KEPT_PAIRS", 3)
    made.units.clear()
    made.kept = 3
    made.pairs[made.ids["x"]].clear()
    assert made.together(-1, made.ids["x"]) and made.kept == sum(map(len, made.pairs.values())) == 1
    assert made.encode(texts).to_pylist() == want and made.kept <= 3
