"""Building the queue: checks, keys, deduplication, pending rows, order and caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.functions.text import content_key, strip, with_clean_urls
from glossa.operators.positions import with_position
from glossa.session import write_observed

KEY = "vlm_content_key"

# Above this many rows a limit is taken by position instead of in one task.
SMALL_LIMIT = 10_000

# A batch of at most this many rows has keys (64 characters each) that may be broadcast.
SMALL_BATCH = 500_000


def require_columns(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        wanted = ", ".join(f"'{c}'" for c in columns)
        raise ValueError(f"Input must include columns {wanted}; missing {missing}.")
    return df


def with_content_key(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """Add the content key; a key column the table lacks counts as empty."""
    parts = {
        f"_key{i}": F.col(f"`{c}`") if c in df.columns else F.lit("") for i, c in enumerate(columns)
    }
    cleaned = with_clean_urls(df, parts)
    return cleaned.withColumn(KEY, content_key([F.col(p) for p in parts])).drop(*parts)


def dedup_first(
    df: DataFrame, column: str = "post_url", ordinal: str = "ordinal", keep_null: bool = False
) -> DataFrame:
    """First row per raw value in input order; nulls are one value unless ``keep_null``.

    The rank filter lets Spark keep one row per value and partition before the shuffle,
    so a value that holds a third of the table costs one row per partition.
    """
    require_columns(df, [column, ordinal])
    if keep_null:
        # Null rows get a group each: all are kept and none share a partition by accident.
        by = [F.col(column), F.when(F.col(column).isNull(), F.col(ordinal))]
    else:
        by = [F.col(column)]
    first = Window.partitionBy(*by).orderBy(F.col(ordinal))
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")


def distinct_keys(results: DataFrame, column: str = KEY) -> DataFrame:
    """Distinct, stripped, non-blank keys of a results table."""
    key = strip(F.col(column).cast("string")).alias(KEY)
    return results.select(key).filter(F.col(KEY) != "").distinct()


def pending(df: DataFrame, processed: DataFrame) -> DataFrame:
    """Rows whose key is not yet processed. Spark broadcasts the keys only while they are small."""
    return df.join(processed.select(KEY), KEY, "left_anti")


def keys_among(processed: DataFrame, batch: DataFrame) -> DataFrame:
    """Processed keys that occur in ``batch``.

    Only for a batch counted to be at most ``SMALL_BATCH`` rows: its keys are broadcast, so
    the results table is scanned but not shuffled, however large it has grown.
    """
    return processed.join(F.broadcast(batch.select(KEY).distinct()), KEY, "left_semi")


def sort_order(
    df: DataFrame,
    columns: tuple[str, ...] | list[str],
    ascending: tuple[bool, ...] | list[bool],
    ordinal: str = "ordinal",
) -> list[Column]:
    """Sort key: present columns, nulls last both ways, ties in input order."""
    if len(ascending) < len(columns):
        raise ValueError("one sort direction is needed per sort column")
    order = [
        F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last()
        for c, up in zip(columns, ascending)
        if c in df.columns
    ]
    return [*order, F.col(ordinal).asc()]


def shuffle_order(key: str, ordinal: str, seed: str) -> list[Column]:
    """A repeatable random order."""
    return [F.sha2(F.concat(F.col(key), F.lit(f"|{seed}")), 256).asc(), F.col(ordinal).asc()]


def group_limit(spark) -> int:
    """Largest rank Spark still cuts before the shuffle."""
    return int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


# Rows of one group that may meet in one task while they are ranked.
RANKED_ROWS = 1_000_000


def top_per_group(df: DataFrame, group: str, n: int, order: list[Column]) -> DataFrame:
    """First ``n`` rows of each group; rows without a group are dropped.

    Each partition sends up to ``n`` rows of a group to the group's task. Where that may be
    more than ``RANKED_ROWS``, or the rank cannot be cut before the shuffle, ranks come from
    global positions instead; both ways give the same rows.
    """
    rows = df.filter(F.col(group).isNotNull())
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n <= group_limit(df.sparkSession) and n * partitions <= RANKED_ROWS:
        ranked = Window.partitionBy(group).orderBy(*order)
        return rows.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= n).drop("_rank")
    placed = with_position(rows, [F.col(group).asc(), *order], "_at")
    # One row per group. While these are few the rows themselves are not shuffled; where they are
    # many no group can hold up a task.
    starts, seen = write_observed(placed.groupBy(group).agg(F.min("_at").alias("_start")), "starts", groups=F.count("*"))
    if seen["groups"] <= SMALL_BATCH:
        starts = F.broadcast(starts)
    return placed.join(starts, group).filter(F.col("_at") - F.col("_start") < n).drop("_at", "_start")


def first_rows(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """First ``n`` rows of the whole table."""
    if n <= SMALL_LIMIT:
        return df.orderBy(*order).limit(n)
    return with_position(df, order, "_at").filter(F.col("_at") < n).drop("_at")
