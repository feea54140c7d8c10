"""What reaches the scan, and what is shuffled."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glossa.config import RetryPolicy
from glossa.operators import attempts, positions, queue
from glossa.plans.prepare import queue_rows, with_media
from glossa.session import write_scratch
from glossa.sources.results import processed_keys
from suite.queries import QUERIES
from suite.schemas import JOB
from suite.views import view


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, sf_dir, tmp_path_factory):
    """Posts and earlier results as tables on disk."""
    folder = tmp_path_factory.mktemp("tables")
    view(spark, sf_dir, "posts").write.parquet(f"{folder}/posts")
    posts = spark.read.parquet(f"{folder}/posts")
    done = queue.with_content_key(posts.filter("ordinal % 3 = 0"), JOB.key_columns)
    done.withColumn("vlm_error", F.lit(None).cast("string")).write.parquet(f"{folder}/results")
    return posts, f"{folder}/results"


def test_keys_are_read_alone(spark, tables):
    text = plan(processed_keys(spark, tables[1]))
    assert "ReadSchema: struct<vlm_content_key:string>" in text
    assert "ReadSchema: struct<vlm_content_key:string,vlm_error:string>" in plan(
        processed_keys(spark, tables[1], retry_errors=True))


def test_a_slice_opens_its_own_files(spark, tables):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = positions.order_table(tables[0], [F.col("ordinal")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    starts = [*sorted(table.offsets.values()), table.count]
    assert len(starts) > 2
    one = table.slice(starts[1], starts[2])
    text = plan(one)
    assert "PartitionFilters: [isnotnull(_part" in text and "BroadcastHashJoin" in text
    files = {r[0] for r in one.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 1
    # One file to scan, so one task.
    assert one.rdd.getNumPartitions() == 1 and one.count() == starts[2] - starts[1]


def test_queue_with_a_media_folder_is_planned_once(spark, tables, tmp_path, monkeypatch):
    posts, results = tables
    (tmp_path / "media").mkdir()
    seen = []
    from glossa.plans import prepare

    def keep(df, label, *rest):
        seen.append((label, plan(df)))
        return write_scratch(df, label, *rest)

    monkeypatch.setattr(prepare, "write_scratch", keep)
    rows = with_media(queue_rows(posts, processed_keys(spark, results), JOB), JOB.with_(media_dir=str(tmp_path / "media")), None)
    assert [label for label, _ in seen] == ["routed"]
    whole = seen[0][1] + plan(rows)
    assert whole.count("LeftAnti") == 1
    assert seen[0][1].count("FileScan") == 2  # posts and results
    assert "/posts]" not in plan(rows)


def test_large_cap_does_not_shuffle_the_rows_by_group(spark, tables):
    rows = queue.with_content_key(tables[0], JOB.key_columns)
    text = plan(queue.top_per_group(rows, "platform", 2000, [F.col("ordinal")]))
    assert "hashpartitioning(platform" not in text and "BroadcastHashJoin" in text


def test_replies_are_parsed_once(spark, sf_dir):
    for name in ("full_json", "parse_reply"):
        text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert text.lower().count("parse_json") + text.lower().count("parsejson") == 1, text


def test_queue_is_two_shuffles_and_no_python(spark, tables):
    posts, results = tables
    rows = with_media(queue_rows(posts, processed_keys(spark, results), JOB), JOB, None)
    text = plan(rows)
    assert "Python" not in text and "Pandas" not in text
    assert "NestedLoop" not in text and "Cartesian" not in text and "LeftAnti" in text
    # First per URL, and distinct keys on the side that is broadcast.
    assert text.count("Exchange hashpartitioning") == 2


def test_small_batches_leave_the_results_unshuffled(spark, tables):
    posts, results = tables
    seen = queue.keys_among(
        spark.read.parquet(results).select(queue.KEY), queue.with_content_key(posts, JOB.key_columns)
    )
    text = plan(seen)
    assert "LeftSemi, BuildRight" in text
    # The only shuffle is the batch's own distinct; the scan of the results has none.
    assert text.count("Exchange hashpartitioning") == 1
    pending = queue.pending(queue.with_content_key(posts, JOB.key_columns), seen)
    assert pending.filter("ordinal % 3 = 0").count() == 0


def test_logs_combine_before_the_shuffle(spark, sf_dir):
    log = attempts.with_reply_error(view(spark, sf_dir, "calls"))
    for df in (
        attempts.decide(log, RetryPolicy(), "primary", "fallback"),
        attempts.planned_wait(log, RetryPolicy(), ["k", "model"]),
    ):
        text = plan(df)
        assert text.count("Exchange") == 1 and "partial_" in text
    assert "HashAggregate" in plan(attempts.planned_wait(log, RetryPolicy(), ["k"]))


@pytest.mark.parametrize("name", ["pending", "first_pass", "fallback_decision", "quota_stop", "media_resolve"])
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "NestedLoop" not in text and "Cartesian" not in text
