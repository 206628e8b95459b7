"""Repeated rows and other layouts of the same rows give the same results."""

from collections import Counter

import numpy as np

from merchlens.llm import mixture, neighbours
from tests.llm.helpers import documents


def test_a_repeated_query_row_is_asked_once(spark):
    random = np.random.default_rng(8)
    rows = [(i, random.normal(size=4).tolist()) for i in range(250)]
    rows += [rows[100]] * 4 + [rows[7]] * 2
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r for r in neighbours.search(df, df.filter("vec_id % 100 = 0")).collect() if r.query_id == 100]
    own = np.array(rows[100][1])
    best = sorted((float(np.sqrt(((np.array(v) - own) ** 2).sum())), i) for i, v in rows if i != 100)[:10]
    assert [(r.score, r.vec_id) for r in sorted(got, key=lambda r: r["rank"])] == best


def test_the_mixed_corpus_does_not_depend_on_the_layout(spark):
    rows = [(None if k % 2 else 7, f"w{k} x{k} y{k}", "s") for k in range(80)]
    docs = documents(spark, rows)
    def corpus(df):
        return Counter((r.doc_id, r.text) for r in mixture.apply_mix(df).collect())

    first = corpus(docs.coalesce(1))
    assert sum(first.values()) > 0 and corpus(docs.orderBy("text").repartition(5)) == first
    assert corpus(docs.orderBy(docs.text.desc()).coalesce(2)) == first
