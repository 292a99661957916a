"""Intermediate tables in the folder that the cluster shares.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir`` and reading
it back: the files outlive any executor, and readers see exactly the rows that
were written.  Where the setting is absent a folder of this process is used,
on a local master alone: elsewhere executors could not see it.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a temporary folder where it is unset."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    master, app = spark.sparkContext.master, spark.sparkContext.applicationId
    if not re.match(r"local(\[[^\]]*\])?$", master):
        raise ValueError(f"spark.checkpoint.dir is not set, and executors of {master} share no folder with the driver")
    if app not in _own:
        _own[app] = "file://" + tempfile.mkdtemp(prefix="sessionweave-")
    return _own[app]


class Scratch:
    """Tables of one operator call; files go when dropped, or with the JVM.

    Those below a stated ``root`` stay until they are dropped.
    """

    def __init__(self, spark: SparkSession, name: str, root: str | None = None):
        self.spark = spark
        self.key = uuid.uuid4().hex
        self.root = root.rstrip("/") if root else f"{shared_root(spark)}/{name}-{self.key}"
        self.tables: dict[str, str] = {}
        if not root:
            path, fs = self._at(self.root)
            fs.deleteOnExit(path)

    def _at(self, where: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(where)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
        """Write ``df`` and read it back with the same schema (partition columns last)."""
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name))
        return self.read(name, df, partition_by)

    def read(self, name: str, like: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def save_buckets(self, df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
        """Write ``df`` hashed into buckets, each sorted by the keys, such that joins on them need no exchange."""
        table = self._table(name)
        df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", self.path(name)).option("compression", "zstd").format("parquet").saveAsTable(table)
        return self.spark.table(table)

    def open_buckets(self, name: str, ddl: str, keys: list[str], buckets: int) -> DataFrame:
        """A table that an earlier application wrote with ``save_buckets`` below this root."""
        table, by = self._table(name), ", ".join(keys)
        self.spark.sql(f"create table {table} ({ddl}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{self.path(name)}'")
        return self.spark.table(table)

    def _table(self, name: str) -> str:
        self.tables[name] = f"scratch_{self.key}_{name.replace('-', '_')}"
        return self.tables[name]

    def names(self) -> list[str]:
        """Names of the tables that stand below the root."""
        path, fs = self._at(self.root)
        return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.tables:
                self.spark.sql(f"drop table if exists {self.tables.pop(name)}")
            path, fs = self._at(self.path(name))
            fs.delete(path, True)
