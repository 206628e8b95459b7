"""Partitioned Parquet tables under one root, with replace and merge sinks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchlens.schemas import LOG_KEYS, PARTITIONS, conform, schema_of
from merchlens.session import materialize

#: Files that a task keeps open while it writes partitions; rows of more of them are sorted by partition.
OPEN_FILES = 16
OPEN_FILES_CONF = "spark.sql.maxConcurrentOutputFileWriters"


def last_entries(entries: DataFrame, key: list[str]) -> DataFrame:
    """The last entry of each key of an append-only log: by its last time, an ended one after one that runs."""
    written = F.struct(F.coalesce("finished_at", "started_at"), F.col("finished_at").isNotNull(), "status")
    rest = [c for c in entries.columns if c not in key]
    last = entries.groupBy(*key).agg(F.max_by(F.struct(*rest), written).alias("_last"))
    return last.select(*[F.col(c) if c in key else F.col(f"_last.{c}") for c in entries.columns])


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def exists(self, table: str) -> bool:
        folder = self._hadoop_path(self.path(table))
        return self._fs(folder).exists(folder)

    def read(self, table: str) -> DataFrame:
        """The table under its declared schema; empty when nothing was written yet."""
        schema = schema_of(table)
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).parquet(self.path(table))
        return last_entries(stored, LOG_KEYS[table]) if table in LOG_KEYS else stored

    def append(self, table: str, df: DataFrame) -> None:
        self._writer(conform(df, table), table).mode("append").parquet(self.path(table))

    def create(self, table: str, df: DataFrame, placed: bool = False) -> DataFrame:
        """Write the first rows of a table and read them back.

        ``placed``: a task holds rows of few partitions already and writes them as they are, a file for each; up to
        ``OPEN_FILES`` of them are open at a time, so that the rows need no sort.
        """
        self._overwrite(table, conform(df, table), placed)
        return self.read(table)

    def replace_partitions(self, table: str, df: DataFrame, in_scope: Column) -> None:
        """Make the partitions matching ``in_scope`` hold exactly the rows of ``df``.

        ``df`` may read the table itself: the writer stages its files and swaps
        them in when every task is done. Dynamic overwrite leaves a partition
        alone when the new rows have none for it, so partitions of the scope
        that were not rewritten are removed afterwards.
        """
        before = self.partitions(table)
        self._overwrite(table, conform(df, table))
        if before is not None:
            self._drop_unwritten(table, before.filter(in_scope))

    def replace_listed(self, table: str, df: DataFrame, listed: DataFrame) -> None:
        """As ``replace_partitions``, for the partitions whose keys ``listed`` holds; ``df`` has rows of no others.

        The rows go straight to their files: they are read once and not stored before. A null key is no partition.
        """
        before = self.partitions(table)
        self._overwrite(table, conform(df, table))
        if before is not None:
            self._drop_unwritten(table, before.join(listed, PARTITIONS[table], "left_semi"))

    def merge(self, table: str, keep: DataFrame, gone: DataFrame, new: DataFrame, placed: bool = False) -> DataFrame:
        """Swap the old rows ``gone`` for ``new`` by rewriting only the partitions they touch.

        ``keep`` and ``gone`` split the current rows of the table. ``placed``: ``new`` is read from stored files, where
        a task holds rows of few partitions; it is neither stored once more nor shuffled.
        """
        keys = PARTITIONS[table]
        new = conform(new, table) if placed else materialize(conform(new, table), f"{table}-new")
        before = self.partitions(table)
        if before is None:
            self._overwrite(table, new, placed)
            return new
        touched = materialize(
            gone.select(*keys).union(new.select(*keys)).distinct().toDF(*[f"_t_{k}" for k in keys]),
            f"{table}-touched",
        )
        same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
        kept = conform(keep, table).join(touched, same, "left_semi")
        self._overwrite(table, kept.unionByName(new), placed)
        self._drop_unwritten(table, before.join(touched, same, "left_semi"))
        return new

    def partitions(self, table: str) -> DataFrame | None:
        """Folder, one file name and the key values of every partition, from a listing (no data is read)."""
        if not self.exists(table):
            return None
        keys = PARTITIONS[table]
        root = self._hadoop_path(self.path(table))
        pattern = self._hadoop_path("/".join([self.path(table), *[f"{k}=*" for k in keys]]))
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        rows = []
        for status in self._fs(root).globStatus(pattern):
            folder = status.getPath().toString()
            parts = [p.split("=", 1)[1] for p in folder.split("/")[-len(keys):]]
            values = [None if p == "__HIVE_DEFAULT_PARTITION__" else unescape(p) for p in parts]
            rows.append((folder, self._any_file(status.getPath()), *values))
        types = {f.name: f.dataType.simpleString() for f in schema_of(table)}
        layout = ", ".join(["_folder string", "_file string", *[f"{k} string" for k in keys]])
        text = self.spark.createDataFrame(rows, layout)
        return text.select("_folder", "_file", *[F.col(k).cast(types[k]).alias(k) for k in keys])

    def _overwrite(self, table: str, staged: DataFrame, placed: bool = False) -> None:
        if not placed:
            writer = self._writer(staged, table).mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").parquet(self.path(table))
            return
        before = self.spark.conf.get(OPEN_FILES_CONF)
        self.spark.conf.set(OPEN_FILES_CONF, OPEN_FILES)
        try:
            writer = staged.write.partitionBy(*PARTITIONS[table]).mode("overwrite")
            writer.option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(self.path(table))
        finally:
            self.spark.conf.set(OPEN_FILES_CONF, before)

    def _writer(self, df: DataFrame, table: str):
        """Rows of one partition are put together, a large one spread over many tasks."""
        keys = PARTITIONS.get(table, [])
        if not keys:
            return df.write
        # The hint lets AQE cut a large partition into files of advisory size.
        return df.hint("rebalance", *keys).write.partitionBy(*keys)

    def _drop_unwritten(self, table: str, old: DataFrame) -> None:
        """Delete those of the partitions ``old`` that still hold a file from before."""
        # One row per partition folder of the scope.
        for row in old.select("_folder", "_file").collect():
            folder = self._hadoop_path(row[0])
            if row[1] and self._fs(folder).exists(self._hadoop_path(f"{row[0]}/{row[1]}")):
                self._fs(folder).delete(folder, True)

    def _any_file(self, folder) -> str | None:
        """Name of one file; an overwrite replaces every file of a partition."""
        found = self._fs(folder).listStatusIterator(folder)
        return found.next().getPath().getName() if found.hasNext() else None

    def _hadoop_path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())
