"""What the operators of this package share: scratch tables, word splitting, training rows."""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package from where the driver did."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    if root not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH"), root]))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder: spark.checkpoint.dir, or the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}" if root.startswith("/") else root
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later steps see one frozen set of rows and do not depend on a lost executor.
    """
    path = scratch_path(importable(df.sparkSession), label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(spark: SparkSession) -> None:
    """Remove every scratch table of this application (when its results have been written)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "x")).getParent()
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from: crc32 of the id as text leaves 1 modulo 3 (null id: learnable, never labelled)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, name: str) -> DataFrame:
    """One row (doc_id, label 0/1) per labelled document that is not held out.

    Rows without id or label are left out; repeated labels of one id count by majority, ties as 1.
    """
    return (
        labels.select("doc_id", F.col(name).cast("double").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    )


def as_array(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.fill_null("") if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column


def split_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words between ASCII white space: vocabulary codes, offsets of each text, and the vocabulary."""
    texts = as_array(texts)
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(texts))
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not real.all():  # an empty text splits into one empty word
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        flat = flat.filter(pa.array(real))
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), offsets, coded.dictionary


def slices(batch: pa.RecordBatch, rows: int):
    """Pieces of a batch, so that work arrays stay small whatever the batch holds."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
