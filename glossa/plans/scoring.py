"""The model call, spread over partitions, one attempt per row and round.

The engine owns retries: after each round the log says which requests to try again, so
the client only ever makes a single call. A round is appended to the durable log before it is
read; no plan that contains the calls is ever run twice by a second action. What the log
already knows of a request is used instead of a call.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.config import RetryPolicy
from glossa.functions.errors import (
    DAILY_MARKS,
    DELAY_HOURS,
    DELAY_SECONDS,
    EXHAUSTED_MARKS,
    RETRYABLE_MARKS,
    SPELLED_DAY,
    SPELLED_LIMIT,
)
from glossa.operators.attempts import with_final, with_reply_error
from glossa.operators.queue import KEY
from glossa.session import write_observed
from glossa.operators.rate import rate_schedule
from glossa.sources.attempts import CALL_COLUMNS, LOG_SCHEMA, append_attempts

# What a client sees of each request. ``response_schema`` is the JSON schema of the wanted reply;
# ``ready_at`` the time, in seconds of the epoch, before which the call should not be made.
REQUEST_COLUMNS = [
    "k", KEY, *CALL_COLUMNS, "prompt", "response_schema", "call_url", "media_path", "mime", "wait_sec", "ready_at", "stops",
]
LOG_COLUMNS = ["k", KEY, *CALL_COLUMNS, "called", "ended_at", "resp", "err"]

# A factory, called once per partition; the client maps request rows to ``resp`` and ``err``.
Client = Callable[[Any], Any]
ClientFactory = Callable[[], Client]


def per_row_client(call: Callable[[dict], Any], threads: int = 1, keep_waits: bool = True) -> ClientFactory:
    """Client from ``call(request) -> reply``; what it raises becomes the attempt's error.

    A reply may be text, a dict or a dataclass instance. ``threads`` calls of a task are made at
    the same time. With ``keep_waits`` a retry is not made before its ``ready_at``. Where a daily quota
    ends the run (``stops``), rows behind the first such error of a task are not called:
    they lie behind the stop, and the log marks them.
    """
    exhausted, retryable, daily = EXHAUSTED_MARKS, RETRYABLE_MARKS, DAILY_MARKS
    day, limit, seconds, hours = SPELLED_DAY, SPELLED_LIMIT, DELAY_SECONDS, DELAY_HOURS

    def factory() -> Client:
        import dataclasses
        import json
        import re
        import time
        from concurrent.futures import ThreadPoolExecutor

        import pandas as pd

        spent: list[str] = []

        def text(reply):
            if reply is None or isinstance(reply, str):
                return reply
            plain = dataclasses.asdict(reply) if dataclasses.is_dataclass(reply) else reply
            return json.dumps(plain, ensure_ascii=False, default=lambda v: getattr(v, "value", str(v)))

        def ends_the_run(error):
            # Narrower than the engine's own test: only errors that are final and daily.
            if re.search(retryable, error) or re.search(seconds, error) or not re.search(exhausted, error):
                return False
            wait = re.search(hours, error)
            if wait:
                return int(wait.group(1)) >= 1
            return bool(re.search(daily, error) or (re.search(day, error) and re.search(limit, error)))

        def one(request):
            if request["stops"] and spent:
                return None, f"Not called after: {spent[0]}", False, time.time()
            if keep_waits:
                time.sleep(max(0.0, request["ready_at"] - time.time()))
            try:
                answer = text(call(request)), None
            except Exception as exc:
                answer = None, str(exc)
                if request["stops"] and ends_the_run(answer[1]):
                    spent.append(answer[1])
            return *answer, True, time.time()

        def run(requests):
            asked = requests.to_dict("records")
            if threads == 1:
                made = [one(r) for r in asked]
            else:
                with ThreadPoolExecutor(threads) as pool:
                    made = list(pool.map(one, asked))
            return pd.DataFrame(made, columns=["resp", "err", "called", "ended_at"])

        return run

    return factory


def call_once(requests: DataFrame, make_client: ClientFactory) -> DataFrame:
    """Log rows for ``requests``: one call each, one client per partition.

    A client's frame has ``resp`` and ``err``, and may have ``called`` and ``ended_at``.
    """
    own = LOG_COLUMNS[:6]

    def run(batches: Iterator) -> Iterator:
        import time

        client = make_client()
        for batch in batches:
            answer = client(batch)
            log = batch[own].copy()
            log["called"] = list(answer["called"]) if "called" in answer else True
            log["ended_at"] = list(answer["ended_at"]) if "ended_at" in answer else time.time()
            log["resp"] = list(answer["resp"])
            log["err"] = list(answer["err"])
            yield log

    return requests.select(*REQUEST_COLUMNS).mapInPandas(run, LOG_SCHEMA)


def with_next(log: DataFrame, policy: RetryPolicy, primary: str, fallback: str) -> DataFrame:
    """Add what each attempt leads to: the same model again, the fallback, or nothing.

    ``next_model`` is null where the row is done. Decided row by row, without a shuffle.
    """
    turn = (
        F.col("_exhausted") & ~F.col("_daily") & (F.col("model") == primary) & F.lit(primary != fallback)
    )
    again = ~F.col("_final")
    return with_final(log, policy).select(
        *log.columns,
        F.when(again, F.col("model")).when(turn, F.lit(fallback)).alias("next_model"),
        F.when(again, F.col("attempt") + 1).when(turn, F.lit(0)).alias("next_attempt"),
        F.when(again, F.col("_wait")).otherwise(0.0).alias("wait_sec"),
    )


@dataclass(frozen=True)
class Scored:
    """The calls of some rows. ``log`` has one row per attempt; those without a ``next_model`` settle
    their ``k``. ``calls`` counts the attempts that were made now, not taken from an earlier run."""

    log: DataFrame
    calls: int


def score(
    rows: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    make_client: ClientFactory,
    policy: RetryPolicy,
    primary: str,
    fallback: str,
    partitions: int,
    log_path: str,
    known: DataFrame | None = None,
    stop_early: bool = False,
    rate: tuple[dict[str, int], int, int] | None = None,
) -> Scored:
    """Call the model for every row until nothing is left to retry.

    ``rows`` has a unique ``k``, the content key and the ``model`` to start with; ``build`` adds the
    request columns. It runs after the rows are spread, so prompts are never shuffled. Each round
    holds only the rows the one before left open, at most twice the allowed attempts. With
    ``stop_early`` a client may skip rows behind a daily quota error of the primary model.

    ``known`` (see ``sources.attempts.reusable``) answers requests without a call. With ``rate`` (requests per
    minute by model, for other models, burst) first calls get a ``ready_at`` from their place among the rows of their
    model (``operators.rate``), so that all tasks together keep one rate; retries wait as the policy says.
    """
    logs: list[DataFrame] = []
    calls = 0
    todo = rows.withColumns({"attempt": F.lit(0), "wait_sec": F.lit(0.0), "ready_at": F.lit(0.0)})
    if rate is not None:
        limits, default, burst = rate
        todo = rate_schedule(todo.drop("ready_at"), "k", "model", limits, default, burst, F.lit(time.time())).drop("rate_rank")
    for _ in range(2 * policy.max_attempts):
        open_rows = 0
        asked = todo
        if known is not None:
            held = build(todo).select("k", KEY, *CALL_COLUMNS).join(known, [KEY, *CALL_COLUMNS])
            held = with_reply_error(held.withColumn("called", F.lit(False)).select(*LOG_COLUMNS))
            replayed, seen = write_observed(
                with_next(held, policy, primary, fallback), "replayed", open_rows=F.count("next_model")
            )
            logs.append(replayed)
            open_rows += seen["open_rows"]
            asked = todo.join(replayed.select("k"), "k", "left_anti")
        spread = asked.repartition(partitions, "k").sortWithinPartitions("k")
        stops = F.lit(stop_early) & (F.col("model") == primary)
        fresh = build(spread).withColumn("stops", stops)
        answered = with_reply_error(call_once(fresh, make_client))
        log, seen = append_attempts(
            with_next(answered, policy, primary, fallback), log_path,
            open_rows=F.count("next_model"), calls=F.count_if("called"),
        )
        logs.append(log)
        open_rows += seen["open_rows"]
        calls += seen["calls"]
        if not open_rows:
            break
        latest = log if known is None else log.unionByName(replayed)
        following = latest.filter("next_model is not null").select(
            "k", F.col("next_model").alias("model"), F.col("next_attempt").alias("attempt"), "wait_sec",
            (F.col("ended_at") + F.col("wait_sec")).alias("ready_at"),
        )
        todo = rows.drop("model").join(following, "k")
    return Scored(reduce(DataFrame.unionByName, logs), calls)


def outcomes(log: DataFrame) -> DataFrame:
    """The attempt that settled each ``k``; a filter, since every row knows what came of it."""
    return log.filter("next_model is null").select(
        "k", F.when(F.col("err").isNull(), F.col("resp")).alias("resp"), "err",
        F.col("model").alias("model_used"),
    )
