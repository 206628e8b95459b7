"""The stages on the small tables and on awkward rows, each held against its operator's brute force."""

from collections import Counter

import numpy as np

import corpus_pipeline
from merchlens.llm import quality
from merchlens.llm.common import DOCUMENT_COLUMNS, store, table
from tests.llm.helpers import documents
from tests.llm.test_operators import brute_windows, classes, fingerprint


def test_stages(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "benchmark", "mixture", "packing"]
    docs, tables = table(spark, folder, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, folder), f"test-{name}")
        tables.append(docs)
    good, single, clean, mixed, packed = tables
    assert all(t.columns == DOCUMENT_COLUMNS for t in tables[:4])
    every = table(spark, folder, "documents")
    model = quality.fit(quality.features(every), table(spark, folder, "labels"))
    scores = {r.doc_id: r.score for r in quality.score_stats(quality.features(every), model).collect()}
    assert {r.doc_id for r in good.collect()} == {i for i, s in scores.items() if s >= 0.5}
    rows = good.collect()
    of = classes([fingerprint(r.text) for r in rows])
    least = {}
    for r in rows:
        c = of[fingerprint(r.text)]
        least[c] = min(r.doc_id, least.get(c, r.doc_id))
    assert sorted(r.doc_id for r in single.collect()) == sorted(least.values())
    items = [r.text for r in table(spark, folder, "benchmark").collect()]
    kept = {r.doc_id for r in clean.collect()}
    for r in single.limit(60).collect():
        assert (r.doc_id in kept) == all(brute_windows(r.text, b) < 0.8 for b in items)
    assert set(mixed.select("doc_id").distinct().collect()) <= set(clean.select("doc_id").collect())
    assert max(Counter(r.doc_id for r in mixed.collect()).values()) <= 2
    ends = sum(int((np.frombuffer(bytes(r.ids), "<u2")[: r.n_tokens] == 50256).sum()) for r in packed.collect())
    assert ends == mixed.count()


def test_stages_on_awkward_rows(spark, folder):
    for rows in (documents(spark), documents(spark, [])):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, folder), f"odd-{name}")
        docs.collect()
