"""A training corpus from raw documents: quality, near copies, benchmark leaks, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each stage's rows as
Parquet and reads them back for the next. All but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from merchlens.llm import decontaminate, mixture, packing, quality, simhash
from merchlens.llm.common import DOCUMENT_COLUMNS, importable, store, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts; it learns from the labelled rows among ``docs``."""
    labels = table(spark, sf_dir, "labels")
    docs = docs.select(*DOCUMENT_COLUMNS)
    model = quality.fit(store(quality.features(docs), "quality-stats"), labels)
    return quality.keep_good(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: SimHash fingerprints within the operator's distance."""
    return simhash.drop_near_duplicates(docs.select(*DOCUMENT_COLUMNS), simhash.WIDTH, simhash.RADIUS)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontaminate.drop_contaminated(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixture.apply_mix(docs.select(*DOCUMENT_COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token rows of fixed length."""
    return packing.pack(docs, packing.Tokens.read(importable(spark)))


STAGES = [
    ("quality", good_quality), ("near_duplicates", one_of_each), ("benchmark", no_benchmark),
    ("mixture", mixed), ("packing", packed),
]
#: SQL expresses none of fingerprints, fitted models and packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
