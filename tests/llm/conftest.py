from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def documents(spark):
    """Table of documents from (doc_id, text) or (doc_id, text, lang)."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def small(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
