"""Tables of SQLite files as a DataFrame source: one task a file, as such files cannot be split."""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class SqliteSource(DataSource):
    """``format("sqlite")`` with options ``path`` (files joined by commas) and ``table``; columns are text, and ``file`` tells the source."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def _paths(self) -> list[str]:
        return [p.removeprefix("file://") for p in self.options["path"].split(",")]

    def schema(self) -> str:
        with sqlite3.connect(f"file:{self._paths()[0]}?mode=ro", uri=True) as con:
            names = [r[1] for r in con.execute(f'pragma table_info("{self.options["table"]}")')]
        return ", ".join(f"`{n}` string" for n in [*names, "file"])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SqliteReader(self._paths(), self.options["table"], schema.fieldNames()[:-1])


class SqliteReader(DataSourceReader):
    def __init__(self, paths: list[str], table: str, names: list[str]):
        self.paths, self.table, self.names = paths, table, names

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        chosen = ", ".join(f'"{n}"' for n in self.names)
        con = sqlite3.connect(f"file:{partition.value}?mode=ro", uri=True)
        try:
            for row in con.execute(f'select {chosen} from "{self.table}"'):
                yield (*(None if x is None else x.decode("utf-8", "replace") if isinstance(x, bytes) else str(x) for x in row), os.path.basename(partition.value))
        finally:
            con.close()


def message_parts(messages, parts):
    """Messages with their parts in order: left outer, so that a message without parts stays."""
    from pyspark.sql import functions as F

    each = parts.select(F.col("message_id").alias("of"), F.struct("time_created", "id", "data").alias("part"))
    ordered = each.groupBy("of").agg(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["data"]).alias("parts"))
    return messages.join(ordered, F.col("id") == F.col("of"), "left").drop("of")


