"""One row of each group of near copies where an id stands for several texts."""

from merchlens.llm import simhash
from tests.llm.helpers import documents


def test_one_id_with_different_texts_keeps_one_row_of_each_group(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    # Id 1 is the least of the groups of a and b; id 2 is the least of that of c and a copy in that of a.
    rows = [(1, a, "s"), (1, b, "s"), (5, b, "s"), (2, a, "s"), (2, c, "s"), (7, c, "s"), (1, b, "s")]
    kept = simhash.drop_near_duplicates(documents(spark, rows), 5).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(1, a), (1, b), (2, c)])
