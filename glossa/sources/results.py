"""Results written earlier, and the keys in them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.operators.queue import KEY, distinct_keys
from glossa.session import path_exists
from glossa.sources.posts import read_csv


def is_csv(path: str) -> bool:
    return path.rstrip("/").endswith(".csv")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Sub-folders of a CSV results table, one per column list; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    folder = F.regexp_extract("path", r"^(.*/columns-[0-9a-f]+)/[^/]*$", 1)
    # One row per column list ever used, a handful.
    return sorted(r.folder for r in files.select(folder.alias("folder")).distinct().collect() if r.folder)


def read_results(spark: SparkSession, path: str) -> DataFrame | None:
    """All results by column name, columns missing from older files null; None if there are none."""
    if not path_exists(spark, path):
        return None
    if not is_csv(path):
        return spark.read.option("mergeSchema", "true").parquet(path)
    parts = [read_csv(spark, version, ordinal=None) for version in _versions(spark, path)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def processed_keys(spark: SparkSession, path: str, retry_errors: bool = False) -> DataFrame:
    """Keys done so far. Nothing written, or no key column, means no keys.

    Failed rows count as done; with ``retry_errors`` only keys with a good row do. From
    Parquet only the key (and error) column is read.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], f"{KEY} string")
    if is_csv(path):
        results = read_results(spark, path)
    else:
        results = spark.read.schema(f"{KEY} string, vlm_error string").parquet(path)
    if results is None or KEY not in results.columns:
        return spark.createDataFrame([], f"{KEY} string")
    if retry_errors and "vlm_error" in results.columns:
        results = results.filter(F.col("vlm_error").isNull())
    return distinct_keys(results)
