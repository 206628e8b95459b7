"""Small tables with every awkward row, for the training-data operators."""

from pyspark.sql import types as T

EXTRA = ["score", "fp", "size", "label", "component_id", "_text", "_piece", "part"]
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in EXTRA],
])
LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (3, "", "a"), (4, None, None), (5, " \t\n ", "b"), (None, "a text without an id", "b"), (None, None, None),
    (6, LONG, "c"), (7, "one", "c"), (8, "one two three", None), (9, "ONE two\tthree", "\U0001f600"),
    (10, "Été à la plage — naïve café, straße 上海 \U0001f600 end", "c"),
]


def documents(spark, rows=TEXTS):
    data = [(i, t, "en", s, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, s in rows]
    return spark.createDataFrame(data, DOCS)
