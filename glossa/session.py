"""Session settings and tables written to the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Settings that change results; the rest of the session is the caller's.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

_local_scratch: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RESULT_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder ``spark.checkpoint.dir`` names; on a cluster with its scheme (that of ``fs.defaultFS`` if none is given).

    Only a local session without the setting gets a temporary folder of its own;
    on a cluster executors could not see it.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if root:
        root = root.rstrip("/")
        if "://" not in root and not root.startswith("file:") and not sc.master.startswith("local"):
            # Shared by agreement, whatever its scheme: what is derived from it is no path of one machine.
            fs, where = _file_system(spark, root)
            root = str(fs.makeQualified(where).toString())
        return root
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = sc.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="glossa-")
    return _local_scratch[app]


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder, removed with its scope or when the driver's JVM ends."""
    path = f"{scratch_root(spark)}/glossa-{label}-{uuid.uuid4().hex}"
    fs, where = _file_system(spark, path)
    # deleteOnExit ignores paths that do not exist yet.
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    opened = _scope.get()
    if opened is not None:
        opened.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside on leaving; what reads them must be done by then."""
    token = _scope.set([])
    try:
        yield
    finally:
        opened = _scope.get()
        _scope.reset(token)
        for path in opened:
            fs, where = _file_system(spark, path)
            fs.delete(where, True)


def shared_path(spark: SparkSession, path: str) -> str:
    """``path``, refused where it can only name a folder of one machine's own disk."""
    if "://" not in path and not path.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{path} has no scheme: on a cluster each executor would look on its own disk; give a URI")
    return path


def write_scratch(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    Cuts the lineage with a columnar table rather than a checkpoint, so later
    readers still prune columns and push filters.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("append").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_observed(df: DataFrame, label: str, **metrics: Column) -> tuple[DataFrame, dict]:
    """``write_scratch`` that also returns aggregates over the rows, taken during the write."""
    seen = Observation()
    named = [value.alias(name) for name, value in metrics.items()]
    table = write_scratch(df.observe(seen, *named), label)
    return table, seen.get
