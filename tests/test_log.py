"""The call log: rounds merged into one file per key bucket, and reads that open only the buckets they need."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from glossa.operators.queue import KEY
from glossa.session import scratch_path
from glossa.sources.attempts import (
    LOG_SCHEMA, append_attempts, log_bucket, merge_rounds, merged_files, read_attempts, reusable, round_folders,
)


def calls(spark, keys=40, attempts=3):
    rows = [
        (k, hashlib.sha256(str(k).encode()).hexdigest(), 1, "primary", a, "p", True, float(a), f"reply {k}" if a == 2 else None,
         None if a == 2 else "500 internal")
        for k in range(keys) for a in range(attempts)
    ]
    return spark.createDataFrame(rows, LOG_SCHEMA)


def logged(spark, log, rounds=3):
    path = scratch_path(spark, "log") + "/log"
    for a in range(rounds):
        append_attempts(log.filter(F.col("attempt") == a), path)
    return path


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_rounds_become_one_file_per_bucket(spark):
    log = calls(spark)
    path = logged(spark, log)
    before = rows_of(read_attempts(spark, path))
    report = merge_rounds(spark, path, buckets=8)
    assert report.rounds == 3 and report.rows == 120 and round_folders(spark, path) == []
    files = merged_files(spark, path)
    assert len(files) == len({b for b, _, _ in files}) == report.files_written <= 8
    assert rows_of(read_attempts(spark, path)) == before == rows_of(log)
    # Nothing left to merge: nothing is read or written.
    assert merge_rounds(spark, path, buckets=8).files_written == 0


def test_small_merged_files_are_merged_again_large_ones_stay(spark):
    log = calls(spark)
    path = logged(spark, log, rounds=1)
    merge_rounds(spark, path, buckets=4)
    append_attempts(log.filter("attempt = 1"), path)
    merge_rounds(spark, path, buckets=4, small_bytes=0)
    assert len(merged_files(spark, path)) == 8
    append_attempts(log.filter("attempt = 2"), path)
    merge_rounds(spark, path, buckets=4)
    assert len(merged_files(spark, path)) == 4
    assert rows_of(read_attempts(spark, path)) == rows_of(log)


def test_reads_open_only_the_buckets_of_their_keys(spark):
    log = calls(spark)
    path = logged(spark, log)
    merge_rounds(spark, path, buckets=16)
    keys = log.select(KEY).limit(1)
    want = keys.select(log_bucket(F.col(KEY), 16)).first()[0]
    read = read_attempts(spark, path, keys=keys, buckets=16)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan or "PartitionFilters: [bucket" in plan
    got = read.collect()
    assert {r[KEY] for r in got} == {r[KEY] for r in log.collect() if int(r[KEY][:4], 16) % 16 == want}
    # Answers for those keys are those of the whole log.
    assert rows_of(reusable(read, keys)) == rows_of(reusable(read_attempts(spark, path), keys))


def test_a_merge_that_stopped_half_way_changes_no_answer(spark):
    log = calls(spark)
    path = logged(spark, log)
    merge_rounds(spark, path, buckets=4)
    # As if the rounds had not been removed yet: every row is there twice.
    append_attempts(log, path)
    doubled = read_attempts(spark, path)
    assert doubled.count() == 2 * log.count()
    keys = log.select(KEY).distinct()
    assert rows_of(reusable(doubled, keys)) == rows_of(reusable(log, keys))
    merge_rounds(spark, path, buckets=4)
    assert rows_of(read_attempts(spark, path)) == rows_of(log)


def test_empty_and_missing_logs(spark, tmp_path):
    assert read_attempts(spark, str(tmp_path / "none")) is None
    path = logged(spark, calls(spark, keys=0))
    assert merge_rounds(spark, path).rows == 0
    assert read_attempts(spark, path).count() == 0
