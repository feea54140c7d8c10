"""The commit ledger: which tables a chunk of results has reached.

A chunk is written once to ``staged/<chunk>/rows`` before any table gets it. After each table's append an
empty marker ``staged/<chunk>/done-<table>`` is made; when every table has the chunk, one row (chunk, rows,
tables, time) is appended to ``entries`` and the staged folder is removed. What is left in ``staged`` is
therefore exactly the chunks a crash interrupted: a start lists that folder and, if it is empty, reads
nothing else. An interrupted chunk is completed from its own staged rows; the tables are read only for the
keys of that chunk (a semi-join with its keys, bounded by ``commit_rows``), so a row is never added twice.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.session import _file_system, path_exists

ENTRY_SCHEMA = "chunk string, rows long, tables array<string>, done_at double"


@dataclass(frozen=True)
class Ledger:
    root: str

    def staged(self, chunk: str) -> str:
        return f"{self.root}/staged/{chunk}"

    def stage(self, rows: DataFrame) -> tuple[str, DataFrame]:
        """Write the chunk's rows once; returns the chunk's name and a scan of them."""
        chunk = f"chunk-{time.strftime('%Y%m%d%H%M%S')}-{uuid.uuid4().hex[:12]}"
        where = f"{self.staged(chunk)}/rows"
        rows.write.parquet(where)
        return chunk, rows.sparkSession.read.schema(rows.schema).parquet(where)

    def mark(self, spark: SparkSession, chunk: str, table: str) -> None:
        fs, where = _file_system(spark, f"{self.staged(chunk)}/done-{table}")
        fs.create(where, True).close()

    def marks(self, spark: SparkSession, chunk: str) -> set[str]:
        fs, where = _file_system(spark, f"{self.staged(chunk)}/done-*")
        found = fs.globStatus(where) or []
        return {str(f.getPath().getName()).removeprefix("done-") for f in found}

    def close(self, spark: SparkSession, chunk: str, rows: int, tables: list[str]) -> None:
        """Record the finished chunk, then remove its staged rows."""
        entry = spark.createDataFrame([(chunk, rows, sorted(tables), time.time())], ENTRY_SCHEMA)
        entry.coalesce(1).write.mode("append").parquet(f"{self.root}/entries")
        fs, where = _file_system(spark, self.staged(chunk))
        fs.delete(where, True)

    def open_chunks(self, spark: SparkSession) -> list[str]:
        """Chunks that some table may lack, oldest first; listing one folder is all a clean start costs."""
        fs, where = _file_system(spark, f"{self.root}/staged/chunk-*")
        found = fs.globStatus(where) or []
        return sorted(str(f.getPath().getName()) for f in found if f.isDirectory())

    def rows(self, spark: SparkSession, chunk: str) -> DataFrame | None:
        where = f"{self.staged(chunk)}/rows"
        if not path_exists(spark, f"{where}/_SUCCESS"):
            # The chunk was not staged whole, so no table got it: the next run queues its keys again.
            return None
        return spark.read.parquet(where)

    def entries(self, spark: SparkSession) -> DataFrame | None:
        where = f"{self.root}/entries"
        return spark.read.schema(ENTRY_SCHEMA).parquet(where) if path_exists(spark, where) else None

    def drop(self, spark: SparkSession, chunk: str) -> None:
        fs, where = _file_system(spark, self.staged(chunk))
        fs.delete(where, True)


def missing_rows(chunk: DataFrame, table: DataFrame | None, on: list[str]) -> DataFrame:
    """Rows of ``chunk`` whose columns ``on`` (the key first) match no row of ``table``.

    ``table`` is narrowed to the chunk's keys by a broadcast of those keys (at most a chunk of them) before
    the anti-join, so a large table is scanned by its key column but never shuffled.
    """
    if table is None:
        return chunk
    key = on[0]
    there = table.select(*on).join(F.broadcast(chunk.select(key).distinct()), key, "left_semi").distinct()
    return chunk.join(there, on, "left_anti")
