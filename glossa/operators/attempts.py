"""Retries as data: from the attempt log to one outcome per key.

An attempt is final when it succeeded, when its error is not worth a retry, or when it
was the last one allowed. The outcome of a key is its first final attempt.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.config import RetryPolicy
from glossa.functions.errors import is_daily, is_exhausted, with_error_class
from glossa.functions.reply import parse_reply_json, reply_error

UNKNOWN_ERROR = "Unknown error"


def with_reply_error(log: DataFrame) -> DataFrame:
    """Give attempts whose reply holds no object the error that says so."""
    return (
        log.withColumn("_parsed", F.when(F.col("err").isNull(), parse_reply_json(F.col("resp"))))
        .withColumn("err", F.coalesce(F.col("err"), reply_error(F.col("resp"), F.col("_parsed"))))
        .drop("_parsed")
    )


def with_final(log: DataFrame, policy: RetryPolicy) -> DataFrame:
    """Add the error tests (``_retryable`` …), ``_final`` and the planned ``_wait``.

    A per-minute limit waits even after the last attempt; a server error only before it.
    """
    attempt, last = F.col("attempt"), policy.max_attempts - 1
    again = (F.col("_per_minute") | F.col("_retryable")) & (attempt < last)
    wait = (
        F.when(F.col("_per_minute"), F.col("_delay_sec") + policy.rate_limit_margin_sec)
        .when(again, policy.base_delay_sec * F.pow(F.lit(2.0), attempt))
        .otherwise(0.0)
    )
    return with_error_class(log, "err", "_").withColumns({"_final": ~again, "_wait": wait})


def _chosen(where: Column | None = None) -> Column:
    """First final attempt, else the last one present, among rows where ``where`` holds.

    Comparing whole structs makes the choice the same however often a task was re-run.
    """
    row = F.struct("attempt", "resp", "err")
    use = F.col("_final") if where is None else F.col("_final") & where
    present = F.lit(True) if where is None else where
    return F.coalesce(F.min(F.when(use, row)), F.max(F.when(present, row)))


def resolve_attempts(log: DataFrame, policy: RetryPolicy, by: list[str]) -> DataFrame:
    """One row per ``by``: the attempt that counts, as ``attempt``, ``resp`` and ``err``.

    ``log`` must already carry reply errors (``with_reply_error``).
    """
    return with_final(log, policy).groupBy(*by).agg(_chosen().alias("_o")).select(*by, "_o.*")


def planned_wait(log: DataFrame, policy: RetryPolicy, by: list[str]) -> DataFrame:
    """Seconds a key waits up to its final attempt.

    One bounded column per allowed attempt, so it is a plain hash aggregate with
    map-side combine, and a repeated log row counts once.
    """
    final_at = F.coalesce(F.min(F.when(F.col("_final"), F.col("attempt"))), F.lit(policy.max_attempts))
    slots = range(policy.max_attempts)
    waits = [F.max(F.when(F.col("attempt") == i, F.col("_wait"))).alias(f"_w{i}") for i in slots]
    spent = [F.when(F.col("_last") >= i, F.coalesce(f"_w{i}", F.lit(0.0))).otherwise(0.0) for i in slots]
    return (
        with_final(log, policy)
        .groupBy(*by)
        .agg(final_at.alias("_last"), *waits)
        .select(*by, reduce(lambda a, b: a + b, spent).alias("wait_sec"))
    )


def decide(
    log: DataFrame, policy: RetryPolicy, primary: str, fallback: str, by: str = "k"
) -> DataFrame:
    """Outcome per key over both models: ``resp``, ``err``, ``model_used`` and ``decision``.

    Keys called on the primary model fall back only after an exhausted, not daily, error;
    keys called on the fallback model alone keep its outcome. One aggregation covers both.
    """
    on_primary, on_fallback = F.col("model") == primary, F.col("model") == fallback
    both = with_final(log, policy).groupBy(by).agg(
        _chosen(on_primary).alias("p"), _chosen(on_fallback).alias("f")
    )
    p_err = F.col("p.err")
    decision = (
        F.when(F.col("p").isNull(), "fallback_only")
        .when(p_err.isNull(), "ok")
        .when(is_daily(p_err), "stop_daily")
        .when(is_exhausted(p_err) & F.lit(primary != fallback), "fallback")
        .otherwise("error")
    )
    from_fallback = F.col("decision").isin("fallback", "fallback_only")
    taken = F.when(from_fallback, F.col("f")).otherwise(F.col("p"))
    return (
        both.withColumn("decision", decision)
        .withColumn("o", taken)
        .select(
            by,
            "decision",
            F.when(F.col("o.err").isNull(), F.col("o.resp")).alias("resp"),
            F.when(F.col("o").isNull(), UNKNOWN_ERROR).otherwise(F.col("o.err")).alias("err"),
            F.when(from_fallback, fallback).otherwise(F.lit(primary)).alias("model_used"),
        )
    )
