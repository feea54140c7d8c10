"""Listing of the media store."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.session import path_exists, shared_path

MANIFEST_SCHEMA = "save_name string, fname string, size long, path string"


def media_manifest(spark: SparkSession, media_dir: str) -> DataFrame:
    """Files of ``<dir>/<save name>/<file>`` with their size; contents are not read.

    Spark lists the whole store on the driver. For a store of many millions of files look
    up the names a queue needs with ``list_media``, or keep a manifest table.
    """
    if not path_exists(spark, media_dir):
        raise FileNotFoundError(f"no media store at {media_dir}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(media_dir)
    where = r"([^/]+)/([^/]+)$"
    return files.select(
        F.regexp_extract("path", where, 1).alias("save_name"),
        F.regexp_extract("path", where, 2).alias("fname"),
        F.col("length").alias("size"),
        "path",
    )


def list_media(names: DataFrame, media_dir: str) -> DataFrame:
    """Manifest rows for the given ``save_name`` values only, one folder listing per name.

    The listings run in the tasks, against the shared store that ``media_dir`` names (a URI, or a
    path in a local session); nothing is listed on the driver. A store that does not exist is an
    error, a name without a folder is not. Tasks use Arrow's file systems with their own
    credentials; where those do not reach the store, and for many millions of names, keep a manifest table.
    """
    spark = names.sparkSession
    if not path_exists(spark, shared_path(spark, media_dir)):
        raise FileNotFoundError(f"no media store at {media_dir}")
    where = media_dir.replace("s3a://", "s3://", 1).replace("s3n://", "s3://", 1)

    def run(batches: Iterator) -> Iterator:
        import pandas as pd
        from pyarrow import fs

        if "://" in where:
            store, root = fs.FileSystem.from_uri(where)
        else:
            store, root = fs.LocalFileSystem(), where.removeprefix("file:")
        for batch in batches:
            found = []
            for name in batch["save_name"]:
                folder = fs.FileSelector(f"{root}/{name}", allow_not_found=True)
                files = [i for i in store.get_file_info(folder) if i.type == fs.FileType.File]
                found += [(name, i.base_name, i.size, f"{media_dir.rstrip('/')}/{name}/{i.base_name}") for i in files]
            yield pd.DataFrame(found, columns=["save_name", "fname", "size", "path"])

    return names.select("save_name").mapInPandas(run, MANIFEST_SCHEMA)
