"""Groups and links of two tokenizers against their definition, token by token."""

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from merchlens.llm import alignment
from merchlens.llm.common import table
from merchlens.llm.registry import QUERIES
from tests.llm.helpers import documents

PARTS = [*"ab .,\n\t\x00éß上海\U0001f600theing<0x>/s' 　​\x1c\x85", "the", " of", "</s>", "<|endoftext|>", "ation", "   ", "'s", "\n ", "▁"]


class Definition:
    def __init__(self):
        with open(alignment.BYTES_VOCABULARY, "rb") as f:
            self.model_a = f.read()
        with open(alignment.PIECES_VOCABULARY, "rb") as f:
            self.model_b = f.read()
        self.a = Tokenizer.from_file(alignment.BYTES_VOCABULARY)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=self.model_b)
        letters = alignment.byte_alphabet()
        self.bytes_a = {i: bytes(letters[c] for c in n) for n, i in self.a.get_vocab(with_added_tokens=False).items()}

    def bytes_b(self, i):
        name = self.b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()

    def __call__(self, text):
        """n_a, n_b, links, groups."""
        if not text:
            return 0, 0, [], ""
        a, b, whole = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text), (" " + text).encode()
        raw_a, raw_b = [self.bytes_a[i] for i in a], [self.bytes_b(i) for i in b]
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            return 0, 0, [], ""
        ends_a, ends_b = np.cumsum(list(map(len, raw_a))).tolist(), np.cumsum(list(map(len, raw_b))).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        own = [([], []) for _ in common]
        for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
            for i, end in zip(ids, ends, strict=True):
                own[bisect_left(common, end)][side].append(i)
        links = [x[-1] * 2**32 + y[-1] for x, y in own]
        groups = ["|".join(",".join(map(str, ids)) for ids in both) for both in own]
        return len(a), len(b), links, ";".join(groups)


@pytest.fixture(scope="module")
def definition():
    return Definition()


@settings(max_examples=250, deadline=None)
@given(texts=st.lists(st.lists(st.sampled_from(PARTS), max_size=25).map("".join), min_size=1, max_size=4))
def test_any_text_is_aligned_as_defined(definition, texts):
    own = alignment.aligner(definition.model_a, definition.model_b)
    n_a, n_b, n_groups, links, groups = own.align(pa.array([*texts, None]))
    got = list(zip(n_a.to_pylist(), n_b.to_pylist(), links.to_pylist(), groups.to_pylist(), strict=True))
    assert got == [definition(t) for t in [*texts, None]]
    assert n_groups.to_pylist() == [len(g[2]) for g in got]


def test_pointers_reach_the_end_of_long_chains():
    # Every token overlaps the next one of the other side; only the last two end together.
    ends_a, ends_b = np.append(np.arange(2, 4001, 2), 4001), np.append(np.arange(1, 4000, 2), 4001)
    label_a, label_b = alignment.terminals(ends_a, ends_b)
    assert set(label_a) == set(label_b) == {len(ends_b) - 1}
    label_a, label_b = alignment.terminals(np.array([1, 3, 6]), np.array([2, 3, 4, 6]))
    assert label_a.tolist() == [1, 1, 3] and label_b.tolist() == [1, 1, 3, 3]
    assert alignment.terminals(np.zeros(0, int), np.zeros(0, int))[0].tolist() == []


def test_pairs_are_bounded_by_the_vocabularies(definition):
    a, b = alignment.surfaces(definition.model_a, definition.model_b)
    assert alignment.most_pairs(a, b) < 400_000
    few = ([b"ab", b"b", b"xab"], [b"ab", b"b", b"q"])
    assert alignment.most_pairs(*few) == sum(x.endswith(y) or y.endswith(x) for x in few[0] for y in few[1])


def expected_rows(definition, docs):
    facts = [(r.doc_id, *definition(r.text)) for r in docs]
    counts = Counter(link for f in facts for link in f[3])
    best: dict[int, int] = {}
    for link, n in counts.items():
        best[link % 2**32] = max(n, best.get(link % 2**32, 0))
    out = []
    for doc_id, n_a, n_b, links, groups in facts:
        out.append((
            doc_id, n_a, n_b, len(links), len(links), sum(counts[x] == best[x % 2**32] for x in links),
            sum(counts[x] for x in links), hashlib.sha256(groups.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def test_every_row_of_the_query(spark, folder, definition):
    got = QUERIES["op12_alignment"](spark, folder).collect()
    assert sorted(map(tuple, got), key=str) == expected_rows(definition, table(spark, folder, "documents").collect())


def test_awkward_rows(spark, definition):
    def query(docs):
        aligned = alignment.align(docs)
        scored = alignment.score_links(aligned, alignment.pair_counts(aligned)).collect()
        return sorted((
            (r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_groups, r.n_best, r.count_sum,
             hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "") for r in scored
        ), key=str)

    docs = documents(spark)
    assert query(docs) == expected_rows(definition, docs.collect())
    assert query(documents(spark, [])) == []
    assert query(documents(spark, [(1, None, "a"), (2, "", "a"), (3, "with ▁ in it", "a")])) == [(k, *[0] * 6, "") for k in (1, 2, 3)]
