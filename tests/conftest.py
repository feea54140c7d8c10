from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from glossa import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def column(spark):
    """Values of one Column expression over a list of texts (or None)."""

    def run(values, expression, kind="string"):
        df = spark.createDataFrame(
            [(i, v) for i, v in enumerate(values)], f"i long, c {kind}"
        ).repartition(2)
        from pyspark.sql import functions as F

        rows = df.select("i", expression(F.col("c")).alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.i)]

    return run
