"""One request rate for the whole cluster: a planned start for every call, from its place in the queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossa.operators.positions import with_position


def _per_minute(model: Column, limits: dict[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, limit in limits.items():
        out = F.when(model == name, F.lit(limit)).otherwise(out)
    return out


def rate_schedule(
    rows: DataFrame,
    position: str,
    model: str,
    limits: dict[str, int],
    default: int,
    burst: int = 0,
    start: Column | float = 0.0,
) -> DataFrame:
    """``rows`` with ``rate_rank`` (the place of the row among its model's rows, by ``position``, from 0) and ``ready_at``.

    The n-th call of a model may start at ``start`` + 60 * floor(max(n - burst, 0) / limit), limit being the model's
    requests per minute (``limits``, else ``default``): the first minute takes ``burst`` more, no later minute
    more than the limit, whichever task makes the call. Ties of ``position`` are broken by the other columns'
    order in the global sort, so a rank is unique. A null model is a model of its own.

    Ranks come from global positions over (model, position) — range-partitioned, never one window over the table —
    minus the count of rows of the models before; those counts are one small aggregate per model.
    """
    placed = with_position(rows, [F.col(model).asc_nulls_first(), F.col(position)], "_at")
    counts = rows.groupBy(model).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(F.col(model).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(model, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    ranked = placed.join(F.broadcast(starts), placed[model].eqNullSafe(starts[model])).drop(starts[model])
    rank = (F.col("_at") - F.col("_first")).cast("long")
    limit = _per_minute(F.col(model), limits, default)
    minute = F.floor(F.greatest(rank - burst, F.lit(0)) / limit)
    begin = start if isinstance(start, Column) else F.lit(float(start))
    return ranked.withColumn("rate_rank", rank).withColumn("ready_at", begin + 60.0 * minute).drop("_at", "_first")
