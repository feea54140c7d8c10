"""Appending results: Parquet tables, CSV folders, mirrors and the annotation table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.functions.cells import cell_text
from glossa.operators.gate import has_payload
from glossa.operators.queue import KEY
from glossa.operators.results import project_to
from glossa.sources.posts import CSV_OPTIONS
from glossa.sources.results import is_csv, read_results

# The writer trims cells unless told not to.
_CSV_WRITE = CSV_OPTIONS | {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def reconcile_header(current: list[str], wanted: list[str]) -> list[str]:
    """The current columns, then the new ones in their order."""
    return current + [c for c in wanted if c not in current]


def append_by_name(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Union by name; columns either side lacks are null, order as ``reconcile_header``."""
    if existing is None:
        return new
    out = existing.unionByName(new, allowMissingColumns=True)
    return out.select(*reconcile_header(existing.columns, new.columns))


def as_text(df: DataFrame) -> DataFrame:
    """Columns as CSV text; null stays null so that it reads back as missing."""
    return df.select(
        *[
            F.when(
                F.col(f"`{f.name}`").isNotNull(),
                cell_text(F.col(f"`{f.name}`"), f.dataType, ("True", "False")),
            ).alias(f.name)
            for f in df.schema
        ]
    )


def append_results(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Append to a results table; the path's suffix decides the format. CSV files have ``rows_per_file`` rows at most.

    Parquet is matched by column name when read. A CSV row has no names, so rows of each
    column list get a folder of their own and reading joins them by name.
    """
    if is_csv(path):
        version = hashlib.sha256(json.dumps(df.columns).encode()).hexdigest()[:12]
        options = _CSV_WRITE | {"maxRecordsPerFile": rows_per_file}
        as_text(df).write.mode("append").options(**options).csv(f"{path}/columns-{version}")
    else:
        df.write.mode("append").parquet(path)


def annotation_rows(
    df: DataFrame,
    columns: list[str],
    own: Callable[[DataFrame], DataFrame] | None = None,
    headers: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows for the annotation table: those with a payload, as key and annotation columns."""
    rows = df.filter(has_payload(columns))
    if own is not None:
        return own(rows)
    wanted = list(headers) if headers else [KEY, *columns]
    return project_to(rows, wanted, {f.name: f.dataType for f in df.schema})


def annotation_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Columns of the annotation table so far; None if it is new, or CSV. Reads every file's footer."""
    existing = None if is_csv(path) else read_results(spark, path)
    return None if existing is None else existing.schema


def append_annotations(df: DataFrame, path: str, schema: T.StructType | None) -> T.StructType | None:
    """Append annotation rows under the columns the table has (``schema``), then new ones.

    Returns the columns the table has now, for the next append.
    """
    if schema is not None:
        types: dict[str, T.DataType] = {f.name: f.dataType for f in schema}
        df = project_to(df, reconcile_header(schema.fieldNames(), df.columns), types)
    append_results(df, path)
    return None if is_csv(path) else df.schema
