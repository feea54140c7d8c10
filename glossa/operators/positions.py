"""Global row positions without a single-task window.

``row_number() over (order by …)`` pulls the whole table into one task. Here the rows
are range-partitioned on the full sort key (which ends in a unique column, so no value
is too frequent to split), sorted and written once; each row keeps its partition and
its place inside it. Position = rows in earlier partitions + place. The only thing the
driver sees is one count per partition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.session import write_scratch

PART, PLACE = "_part", "_place"
_PLACE_BITS = (1 << 33) - 1


@dataclass(frozen=True)
class OrderedTable:
    """A sorted table on disk. ``offsets`` maps partition → position of its first row."""

    table: DataFrame
    offsets: dict[int, int]
    count: int

    def rows(self, name: str = "pos", start: int = 0) -> DataFrame:
        """All rows with their position, counted from ``start``."""
        return self._numbered(self.table, name, start)

    def slice(self, first: int, last: int, name: str = "pos") -> DataFrame:
        """Rows at positions ``first <= pos < last``; folders of other parts are not opened."""
        ends = [*sorted(self.offsets.values())[1:], self.count]
        hit = [
            part
            for (part, begin), end in zip(sorted(self.offsets.items()), ends)
            if begin < last and end > first
        ]
        low, high = (hit[0], hit[-1]) if hit else (0, -1)
        # A condition on the folder column: Spark prunes folders when it plans the scan.
        part = self.table.filter(F.col(PART).between(low, high))
        return self._numbered(part, name, 0).filter((F.col(name) >= first) & (F.col(name) < last))

    def _numbered(self, rows: DataFrame, name: str, start: int) -> DataFrame:
        spark = rows.sparkSession
        # One row per written partition: bounded by the shuffle partition count.
        offsets = spark.createDataFrame(list(self.offsets.items()), f"{PART} int, _offset long")
        return (
            rows.join(F.broadcast(offsets), PART)
            .withColumn(name, F.col("_offset") + F.col(PLACE) + F.lit(start))
            .drop(PART, PLACE, "_offset")
        )


def order_table(df: DataFrame, order: list[Column], label: str = "ordered") -> OrderedTable:
    """Sort by ``order`` (must be total: end it in a unique column) and write once."""
    placed = (
        df.orderBy(*order)
        .withColumn(PART, F.spark_partition_id())
        .withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)))
    )
    table = write_scratch(placed, label, (PART,))
    counts = sorted((r[PART], r["n"]) for r in table.groupBy(PART).agg(F.count("*").alias("n")).collect())
    offsets: dict[int, int] = {}
    total = 0
    for part, n in counts:
        offsets[part] = total
        total += n
    return OrderedTable(table, offsets, total)


def with_position(df: DataFrame, order: list[Column], name: str = "pos", start: int = 0) -> DataFrame:
    return order_table(df, order).rows(name, start)


def chunk_ids(df: DataFrame, pos: str, chunk_size: int, name: str = "chunk_id") -> DataFrame:
    """Number of the block of ``chunk_size`` rows a zero-based position falls in."""
    return df.withColumn(name, F.floor(F.col(pos) / F.lit(chunk_size)).cast("long"))
