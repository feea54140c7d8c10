"""Annotate large tables of media posts with structured model output, on Spark."""

from glossa.config import JobConfig, RetryPolicy, load_job
from glossa.operators.results import run_summary
from glossa.plans.prepare import prepare
from glossa.plans.run import RunReport, run_job, run_project, run_queue
from glossa.plans.scoring import per_row_client
from glossa.session import configure
from glossa.streaming.incremental import annotate_stream

__all__ = [
    "JobConfig",
    "RetryPolicy",
    "RunReport",
    "annotate_stream",
    "configure",
    "load_job",
    "per_row_client",
    "prepare",
    "run_job",
    "run_project",
    "run_queue",
    "run_summary",
]
