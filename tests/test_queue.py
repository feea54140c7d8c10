"""Queue building: quirks, skew and plans."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from glossa.operators import positions, queue
from glossa.plans.prepare import prepare, queue_rows
from suite.schemas import JOB


def posts(spark, rows):
    return spark.createDataFrame(rows, "ordinal long, post_url string, media_url string, platform string")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_keys(spark):
    return spark.createDataFrame([], f"{queue.KEY} string")


def test_null_urls_collapse_unless_kept(spark):
    df = posts(spark, [(1, None, "a", "x"), (2, None, "b", "x"), (3, "u", "c", "x"), (4, "u", "d", "x")])
    assert sorted(r.ordinal for r in queue.dedup_first(df).collect()) == [1, 3]
    assert sorted(r.ordinal for r in queue.dedup_first(df, keep_null=True).collect()) == [1, 2, 3]


def test_dedup_is_on_the_raw_value(spark):
    df = posts(spark, [(1, "https://x.com/statuses/1", None, "x"), (2, "https://x.com/status/1", None, "x")])
    keyed = queue.with_content_key(queue.dedup_first(df), JOB.key_columns)
    assert keyed.count() == 2 and keyed.select(queue.KEY).distinct().count() == 1


def test_required_columns(spark):
    with pytest.raises(ValueError, match="'platform'"):
        queue_rows(posts(spark, []).drop("platform"), no_keys(spark), JOB)
    with pytest.raises(ValueError, match="post_url"):
        queue.dedup_first(posts(spark, []).drop("post_url"))


def test_names_a_run_uses_are_refused(spark):
    for name in ("mime", "err", "_pos"):
        df = posts(spark, [(1, "a", None, "x")]).withColumn(name, F.lit(1))
        with pytest.raises(ValueError, match=name):
            prepare(df, no_keys(spark), JOB)


def test_null_group_is_dropped_by_the_cap(spark):
    df = posts(spark, [(1, "a", None, None), (2, "b", None, "x"), (3, "c", None, "x"), (4, "d", None, "y")])
    rows = queue_rows(df, no_keys(spark), JOB.with_(rows_per_platform=1))
    assert sorted(r.ordinal for r in rows.collect()) == [2, 4]
    assert queue_rows(df, no_keys(spark), JOB).count() == 4


def test_cap_groups_by_the_first_sort_column(spark):
    df = posts(spark, [(i, f"u{i}", f"m{i % 2}", "x") for i in range(6)])
    rows = queue_rows(df, no_keys(spark), JOB.with_(rows_per_platform=1, sort_columns=("media_url",)))
    assert sorted(r.ordinal for r in rows.collect()) == [0, 1]
    # Group column absent: a plain limit.
    rows = queue_rows(df, no_keys(spark), JOB.with_(rows_per_platform=2, sort_columns=("nothing",)))
    assert sorted(r.ordinal for r in rows.collect()) == [0, 1]


def test_large_cap_and_limit_equal_the_small_way(spark, monkeypatch):
    df = spark.range(3000).select(
        F.col("id").alias("ordinal"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g")
    )
    order = queue.sort_order(df, ["g", "ordinal"], [True, False])
    small = queue.top_per_group(df, "g", 50, order)
    first = queue.first_rows(df, 70, order)
    want = (sorted(r.ordinal for r in small.collect()), sorted(r.ordinal for r in first.collect()))
    monkeypatch.setattr(queue, "group_limit", lambda _: 10)
    monkeypatch.setattr(queue, "SMALL_LIMIT", 10)
    large = queue.top_per_group(df, "g", 50, order)
    first = queue.first_rows(df, 70, order)
    assert (sorted(r.ordinal for r in large.collect()), sorted(r.ordinal for r in first.collect())) == want


def test_sort_nulls_last_both_ways_and_paired_by_name(spark):
    df = posts(spark, [(1, "a", None, "x"), (2, "b", "m", "y"), (3, "c", "z", "x"), (4, "d", "q", None)])
    order = queue.sort_order(df, ["platform", "absent", "media_url"], [False, True, False])
    assert [r.ordinal for r in df.orderBy(*order).collect()] == [2, 3, 1, 4]
    with pytest.raises(ValueError):
        queue.sort_order(df, ["platform", "media_url"], [True])


def test_positions_are_dense_and_slices_exact(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5003).alias("v")).repartition(7)
    # Small data would be coalesced into one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table = positions.order_table(df, [F.col("v").desc()])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = [(r.pos, r.v) for r in table.rows().collect()]
    assert [v for _, v in sorted(rows)] == sorted((v for _, v in rows), reverse=True)
    assert sorted(p for p, _ in rows) == list(range(5000)) and len(table.offsets) > 1
    part = {r.pos for r in table.slice(1000, 2500).collect()}
    assert part == set(range(1000, 2500))
    assert table.slice(6000, 7000).count() == 0


def test_shuffle_keeps_rows_and_repeats(spark):
    df = posts(spark, [(i, f"u{i}", None, "x") for i in range(40)])
    job = JOB.with_(shuffle_batch=True, shuffle_seed="s")

    def order(job):
        rows = prepare(df, no_keys(spark), job).ordered.rows().collect()
        return [r.ordinal for r in sorted(rows, key=lambda r: r.pos)]

    assert order(job) == order(job) != order(JOB)
    assert sorted(order(job)) == sorted(order(JOB))


def test_nothing_pending_is_no_queue(spark):
    df = posts(spark, [(1, "a", None, "x")])
    done = queue.with_content_key(df, JOB.key_columns)
    assert prepare(df, queue.distinct_keys(done), JOB) is None


def test_ranks_are_cut_before_the_shuffle(spark):
    df = posts(spark, [(1, "a", None, "x")])
    text = plan(queue_rows(df, no_keys(spark), JOB.with_(rows_per_platform=5)))
    assert text.count("WindowGroupLimit") == 4, text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_hot_url_sends_one_row_per_partition(spark):
    """A value on most rows: the shuffle before the final rank carries a handful of them."""
    df = spark.range(20_000, numPartitions=4).select(
        F.col("id").alias("ordinal"),
        F.when(F.col("id") % 10 < 9, "hot").otherwise(F.col("id").cast("string")).alias("post_url"),
    )
    unique = queue.dedup_first(df)
    assert unique.count() == 2001
    unique.collect()
    text = plan(unique)
    assert text.index("WindowGroupLimit [post_url") < text.index("Exchange hashpartitioning(post_url")
    assert "Partial" in text
