"""Stopping at the first row that hit the primary model's daily quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions.errors import is_daily

_NEVER = 2**63 - 1


def quota_flag(error: Column, model_used: Column, primary: str) -> Column:
    return is_daily(error) & F.coalesce(model_used == primary, F.lit(False))


def stop_at_quota(df: DataFrame, pos: str, flag: Column) -> DataFrame:
    """Rows up to and including the first flagged one.

    The stop is a scalar subquery over one aggregate: no join, and no running window
    over the whole table.
    """
    stop = df.filter(flag).agg(F.min(pos))
    return df.filter(F.col(pos) <= F.coalesce(stop.scalar(), F.lit(_NEVER)))
