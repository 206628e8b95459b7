"""Padded licence notices at every place, against all windows."""

import numpy as np
import pytest

from merchlens.llm import licenses
from tests.llm.helpers import documents

CASES = [("cc-by-nc", "licensed under the creative commons cc by nc 4 0"), ("mit", "released under the terms of the mit license"),
         ("mit", "released under mit license the")]


def runs_of(words, template):
    """Runs of matching starts: (first, end, largest share of distinct words)."""
    parts, out = template.split(), []
    for s in range(len(words)):
        share = len(set(words[s : s + 2 * len(parts)]) & set(parts)) / len(set(parts))
        if share >= 0.9 - 1e-9:
            if out and out[-1][1] == s:
                out[-1] = (out[-1][0], s + 1, max(share, out[-1][2]))
            else:
                out.append((s, s + 1, share))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_windows_equal_all_starts(seed):
    random = np.random.default_rng(seed)
    known = licenses.Templates({})
    vocabulary = sorted({w for _, text in licenses.TEMPLATES for w in text.split()})
    for _ in range(60):
        words = [str(random.choice(vocabulary)) if random.random() < 0.5 else "x" for _ in range(40)]
        t = int(random.integers(len(licenses.TEMPLATES)))
        for w in licenses.TEMPLATES[t][1].split():
            words += [w] + ["pad"] * int(random.integers(0, 3))
        words = [w.encode() for w in words]
        hits = [(i, known.rank[w]) for i, w in enumerate(words) if w in known.rank]
        got = known.blocks(hits, len(words))
        for k, (_, template) in enumerate(licenses.TEMPLATES):
            mine = [(m[2], m[4]) for m in got if m[0] == k]
            runs = runs_of([w.decode() for w in words], template)
            assert all(any(a <= s < b for a, b, _ in runs) for s, _ in mine)
            assert [max((c for s, c in mine if a <= s < b), default=0) for a, b, _ in runs] == [share for *_, share in runs]


def test_label_and_score_do_not_depend_on_place(spark):
    rows = [(100 * k + offset, " ".join(["word"] * offset + [text, "tail " * 20]), "s")
            for k, (_, text) in enumerate(CASES) for offset in range(15)]
    for r in licenses.scan(documents(spark, rows)).collect():
        assert CASES[r.doc_id // 100][0] in {m.label for m in r.matches}
        assert max(m.containment for m in r.matches) == 1.0
