"""Input posts, from CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell texts that mean "missing".
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}


def missing_to_null(c: Column) -> Column:
    return F.when(~c.isin(*MISSING_TEXTS), c)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV table, from its first record only."""
    return spark.read.options(**CSV_OPTIONS).csv(path, enforceSchema=False).columns


def read_csv(
    spark: SparkSession,
    path: str,
    multiline: bool = True,
    types: dict[str, str] | None = None,
    ordinal: str | None = "ordinal",
) -> DataFrame:
    """Read CSV as text; missing-value texts become null.

    ``types`` casts named columns (bad cells become null). ``ordinal`` numbers rows by
    file, block and place, so "first" means first in the input. Quoted line breaks need
    ``multiline``, which makes each file one task; keep files moderate, or turn it off.
    A file whose header differs from the first file's is an error: its cells would be misread.
    """
    names = csv_header(spark, path)
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # Without enforceSchema each file's header is compared with the names.
    raw = spark.read.options(**CSV_OPTIONS, multiLine=multiline, enforceSchema=False).schema(text).csv(path)
    columns = []
    for name in names:
        value = missing_to_null(F.col(f"`{name}`"))
        wanted = (types or {}).get(name)
        columns.append((value.try_cast(wanted) if wanted else value).alias(name))
    if ordinal and ordinal not in names:
        columns.append(input_order().alias(ordinal))
    return raw.select(*columns)


def input_order() -> Column:
    """Input position of a file row: comparable, unique, stable while the files are."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_posts(spark: SparkSession, path: str, ordinal: str = "ordinal", **options) -> DataFrame:
    """Posts from a ``.csv`` path or, else, Parquet."""
    if path.rstrip("/").endswith(".csv"):
        return read_csv(spark, path, ordinal=ordinal, **options)
    posts = spark.read.parquet(path)
    if ordinal not in posts.columns:
        posts = posts.withColumn(ordinal, input_order())
    return posts
