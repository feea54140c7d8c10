"""Small helpers the operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from glossa.session import configure

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


# Rows of a batch between the JVM and Python. Whole texts travel, so the usual ten thousand would be too many.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the operators rely on: bounded batches, and those that change results."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return configure(spark)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, after which its worker hands free memory back; idle workers stay alive beside busy ones."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def release(spark: SparkSession) -> None:
    """Give back the disk of shuffles whose tables are written.

    Spark deletes the files of a shuffle once the driver's JVM finds that nothing refers to it, which on a
    driver with little garbage may be long after. Plans die in the first collection and what they hold in the second.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def repeats_an_id(rows: DataFrame) -> bool:
    return bool(rows.groupBy("doc_id").count().filter("count > 1").limit(1).count())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, divisor: int) -> Column:
    """crc32 of the id's decimal text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text; null is empty, lone surrogates become '?' as in the JVM."""
    return text.encode("utf-8", "replace") if text else b""


def blocks(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring items whose sizes sum to ``limit`` at most, or hold one item."""
    first, total = 0, 0
    for i, size in enumerate(sizes):
        if i > first and total + size > limit:
            yield first, i
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def sample_per_group(rows: DataFrame, group: str, most: int, seed: int, key: str = "doc_id") -> DataFrame:
    """Up to ``most`` distinct (key, group) rows of each group, lowest hash of the key first.

    Meant for narrow rows and few groups: ``most`` times the groups bounds the result.
    """
    ranked = Window.partitionBy(group).orderBy(F.xxhash64(key, F.lit(seed)), key)
    return (
        rows.select(key, group).distinct().withColumn("_n", F.row_number().over(ranked))
        .filter(F.col("_n") <= most).drop("_n")
    )


def with_text_columns(
    df: DataFrame, column: str, fields: dict[str, tuple[str, pa.DataType]], compute: Callable[[list], list], rows: int = 1000
) -> DataFrame:
    """All columns of ``df`` and those in ``fields`` (name: Spark and Arrow type), which replace any of that name.

    ``compute`` turns up to ``rows`` values of ``column`` into one list per field. The other columns
    pass as Arrow data, so nulls and large integers stay as they are.
    """
    kept = df.drop(*[f for f in fields if f != column])
    returned = [c for c in kept.columns if c not in fields]
    schema = kept.select(*returned).schema
    for name, (kind, _) in fields.items():
        schema = schema.add(name, DataType.fromDDL(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = compute(part.column(column).to_pylist())
                arrays = [part.column(c) for c in returned]
                arrays += [pa.array(values, kind) for values, (_, kind) in zip(made, fields.values())]
                yield pa.RecordBatch.from_arrays(arrays, names=[*returned, *fields])

    return kept.mapInArrow(lean(run), schema)


def keep_texts(df: DataFrame, column: str, wanted: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``df`` whose ``column`` is ``wanted``, as Arrow data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                yield part.filter(pa.array(wanted(part.column(column).to_pylist()), pa.bool_()))

    return df.mapInArrow(lean(run), df.schema)
