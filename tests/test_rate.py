"""One request rate for the whole cluster."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from glossa import per_row_client, run_job
from glossa.operators.rate import rate_schedule
from glossa.sources.attempts import read_attempts
from suite.schemas import JOB


def test_no_minute_over_the_limit_whatever_the_partitions(spark):
    rows = spark.range(5000).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("model")).repartition(7)
    got = rate_schedule(rows, "pos", "model", {"a": 40}, 25, burst=10, start=100.0).collect()
    per_minute = Counter((r.model, (r.ready_at - 100.0) // 60) for r in got)
    assert all(n <= (40 if m == "a" else 25) + (10 if minute == 0 else 0) for (m, minute), n in per_minute.items())
    # Ranks are dense and follow the position within each model.
    for model in ("a", "b"):
        mine = sorted((r.pos, r.rate_rank) for r in got if r.model == model)
        assert [rank for _, rank in mine] == list(range(len(mine)))


def test_ties_and_null_models(spark):
    rows = spark.createDataFrame([(1, None), (1, None), (0, "a"), (2, "a")], "pos long, model string")
    got = rate_schedule(rows, "pos", "model", {"a": 1}, 1).collect()
    assert sorted(r.rate_rank for r in got if r.model is None) == [0, 1]
    assert sorted((r.pos, r.ready_at) for r in got if r.model == "a") == [(0, 0.0), (2, 60.0)]


def test_a_run_with_a_rate_calls_every_row_once(spark, tmp_path, sf_dir):
    from suite.views import view

    posts = view(spark, sf_dir, "posts").limit(30)

    def call(request):
        return {"mood": "calm"}

    job = JOB.with_(results_path=str(tmp_path / "r"), requests_per_minute={JOB.primary_model: 1000, JOB.fallback_model: 1000},
                    default_requests_per_minute=1000, score_partitions=3)
    run_job(posts, job, per_row_client(call, keep_waits=False))
    log = read_attempts(spark, job.log_path).filter("called").collect()
    assert log and len(log) <= 30


def test_waves_double_up_to_a_chunk():
    from glossa.plans.run import chunk_bounds

    assert chunk_bounds(50, 16, 3) == [(0, 3), (3, 6), (9, 12), (21, 16), (37, 16)]
    assert chunk_bounds(10, 4) == [(0, 4), (4, 4), (8, 4)]
    assert chunk_bounds(0, 4, 2) == []
    assert sum(size for _, size in chunk_bounds(10**6, 1000, 1)) >= 10**6
