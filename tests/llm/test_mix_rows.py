"""Rows without id, with repeated ids and repeated rows are mixed as ``mix`` takes them."""

from collections import Counter

import pytest

from merchlens.llm import mixture
from tests.llm.helpers import documents


@pytest.mark.parametrize("piece", [3, 50_000])
def test_every_row_has_its_own_copies(spark, monkeypatch, piece):
    monkeypatch.setattr(mixture, "PIECE", piece)
    rows = [(None if k % 3 == 0 else k // 4, " ".join(f"w{k}x{i}" for i in range(3 + k % 7)), "abc"[k % 5 % 3]) for k in range(120)]
    rows += [(None, "the same row again", "a")] * 25 + [(500, "the same row again", None)] * 11 + [(501, None, "b"), (501, "", "b")]
    docs = documents(spark, rows)
    expected = Counter()
    for r in mixture.mix(docs, ["doc_id", "text", "source"]).collect():
        expected[r.doc_id, r.text or "", r.source] += r.copies
    got = Counter((r.doc_id, r.text or "", r.source) for r in mixture.apply_mix(docs).collect())
    assert got == +expected and any(i is None for i, _, _ in got)
