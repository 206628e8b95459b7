"""Session settings and materialised intermediates."""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"
SCRATCH_FOLDER = "merchlens-scratch"


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for materialised intermediates: the shared one the cluster names; on one machine else one in the warehouse folder."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return f"{root.rstrip('/')}/{SCRATCH_FOLDER}/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str = "stage", compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    Later steps then see one frozen set of rows, read only the columns they
    need, and do not depend on blocks held by an executor. ``compression`` is
    that of the session unless given.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    for made in _open_scopes()[-1:]:
        made.append((label, path))
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


_scopes = threading.local()


def _open_scopes() -> list[list[tuple[str, str]]]:
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    return _scopes.open


@contextmanager
def passing(spark: SparkSession, but: str = "") -> Iterator[None]:
    """Delete at the end what this thread materialises within, so that it does not take disk until the application ends.

    What has the label ``but`` stays; a scope around this one, if there is one, deletes it. Nothing else that is made
    within may be read later.
    """
    _open_scopes().append([])
    try:
        yield
    finally:
        made = _open_scopes().pop()
        for around in _open_scopes()[-1:]:
            around.extend(x for x in made if x[0] == but)
        for label, path in made:
            if label != but:
                _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Settings of jobs that move all rows of an import.
LEAN = {
    # Bytes of a method that the JVM compiles at most; it interprets larger ones, as rows of many columns make, far slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # What a job has shuffled is deleted when it ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


@contextmanager
def lean(spark: SparkSession, more: dict | None = None) -> Iterator[None]:
    """Run what is started within under the settings of ``LEAN`` and ``more``; the session is left as it was."""
    settings = {**LEAN, **(more or {})}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediates of this application (call when a job has published)."""
    _delete(spark, scratch_root(spark))
