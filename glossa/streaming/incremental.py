"""Annotating posts as files arrive."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from glossa.config import JobConfig
from glossa.operators.queue import KEY, dedup_first, with_content_key
from glossa.plans.run import run_job
from glossa.plans.scoring import ClientFactory
from glossa.session import configure, scratch_scope, write_observed
from glossa.sources.results import processed_keys

# Keyed state needs a state store that keeps it in RocksDB, on the executors that own the keys.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
}


# Executors cannot import the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class FirstOfKey(StatefulProcessor):
    """Lets through the first row (smallest ``ordinal``) of each content key the stream has not seen yet.

    The state of a key is one flag, set by its first row or by the initial state (keys in the results when
    the stream starts). It is kept in the checkpoint and committed with the batch, so a batch that fails is
    replayed with the state from before it. The empty key (posts without key values) is never done, as in
    ``processed_keys``: its first row of every batch passes and no state is kept for it.
    """

    def __init__(self, ordinal: str):
        self.ordinal = ordinal

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "done boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        empty = key[0] == ""
        if not empty and self.seen.exists():
            return
        if not empty:
            self.seen.update((True,))
        yield pd.concat(frames).sort_values(self.ordinal, kind="stable").head(1)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self.seen.update((True,))

    def close(self) -> None:
        pass


def first_of_new_keys(posts: DataFrame, job: JobConfig) -> DataFrame:
    """A stream of the first row of every content key that is neither in the results nor seen before; with ``KEY``."""
    spark = posts.sparkSession
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    keyed = with_content_key(posts, job.key_columns)
    done = processed_keys(spark, job.results_path, job.retry_errors)
    return keyed.groupBy(KEY).transformWithStateInPandas(
        FirstOfKey(job.ordinal), keyed.schema, "Append", "None", initialState=done.groupBy(KEY)
    )


def annotate_stream(
    posts: DataFrame,
    job: JobConfig,
    client: ClientFactory,
    checkpoint: str,
    manifest: DataFrame | None = None,
    state: bool = False,
) -> StreamingQuery:
    """Run the job on each micro-batch of a streaming ``posts``, then stop.

    Of rows that share a content key the first in input order is scored. Needs an ``ordinal`` column in the stream.

    With ``state`` (not with ``retry_errors``, whose failed keys come back) a keyed state in the checkpoint
    remembers every key: it starts from the keys in the results when the checkpoint is new, and lets only
    the first row of a new key through. A batch then reads neither the results nor the call log, so what a
    batch reads does not grow with them. The first batch of each start is checked against both as well: after
    a crash it is the batch that failed, which may have reached the results and the log before it did.
    Without ``state`` every batch is checked against the results, and only the first row per key of the
    batch itself is kept.

    The two differ where rows share a raw post URL but not a content key: a run keeps the first row per raw
    URL of what reaches it, and the state has by then removed rows of keys already done, so a later row of
    that URL can be scored with ``state`` where without it the earlier row hides it.
    """
    configure(posts.sparkSession)
    first = [True]
    keyed = state and not job.retry_errors
    stream = first_of_new_keys(posts, job) if keyed else posts

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            # Read from the source once, however many jobs the run takes.
            arrived, seen = write_observed(batch, "batch", rows=F.count("*"))
            if keyed:
                once = arrived.drop(KEY)
            else:
                once = dedup_first(with_content_key(arrived, job.key_columns), KEY, job.ordinal).drop(KEY)
            run_job(once, job, client, manifest, post_count=seen["rows"], repair=first[0], fresh_keys=keyed and not first[0])
            first[0] = False

    return (
        stream.writeStream.foreachBatch(run_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
