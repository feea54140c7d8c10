"""Score a queue chunk by chunk and append the results.

Each chunk is a commit: its rows are in the results table, with their keys, before the
next chunk starts, so a stopped run resumes behind the last commit. The driver holds
counts and one stop position per chunk, never rows. Calls are kept in the log as tasks end, and a
later run uses what the log knows of its keys instead of calling again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glossa.config import JobConfig
from glossa.functions.prompts import media_prompt, url_prompt
from glossa.operators.annotate import annotate, annotation_column_names, second_pass_rows, second_prompt
from glossa.operators.gate import annotation_gate
from glossa.operators.queue import KEY, SMALL_BATCH, keys_among, with_content_key
from glossa.operators.quota import quota_flag
from glossa.operators.results import column_order, project_to, result_columns, result_rows, with_analysis
from glossa.plans.prepare import ROUTE_COLUMNS, Queue, prepare
from glossa.plans.scoring import ClientFactory, outcomes, score
from glossa.schema_spec import response_schema, schema_spec
from glossa.session import configure, scratch_scope, shared_path, write_observed
from glossa.sinks.ledger import Ledger, missing_rows
from glossa.sinks.tables import annotation_rows, annotation_schema, append_annotations, append_results
from glossa.sources.attempts import merge_rounds, read_attempts, reusable
from glossa.sources.posts import read_posts
from glossa.sources.results import processed_keys, read_results

POS = "_pos"


@dataclass(frozen=True)
class RunReport:
    """What a run did: rows queued and written, calls made, and the position in the queue at which a
    daily quota ended it (null if none did)."""

    queued: int
    written: int
    calls: int = 0
    stopped_at: int | None = None

    @property
    def stopped(self) -> bool:
        return self.stopped_at is not None


def call_requests(rows: DataFrame, number: int, prompt: Column, schema: str) -> DataFrame:
    """Request columns: the prompt for media, or for the URL alone, and the schema of the reply."""
    has_media, url = F.col("media_fname").isNotNull(), F.col("call_url")
    asked = F.when(has_media, media_prompt(prompt, url)).otherwise(url_prompt(prompt, url))
    return rows.withColumn("prompt", asked).select(
        "k", KEY, F.lit(number).alias("pass"), "model", "attempt", F.sha2("prompt", 256).alias("prompt_hash"),
        "prompt", F.lit(schema).alias("response_schema"), "call_url",
        F.when(has_media, F.col("media_path")).alias("media_path"), "mime", "wait_sec", "ready_at",
    )


@dataclass
class _Calls:
    """How a run calls its model, and what it knows of earlier calls."""

    job: JobConfig
    client: ClientFactory
    known: DataFrame | None
    made: int = 0

    def outcomes(self, rows: DataFrame, count: int, number: int, prompt: Column) -> DataFrame:
        """Media is called on the primary model, a URL alone on the fallback model.

        ``count`` rows at most decide the number of tasks, whatever the session's cores.
        """
        job = self.job
        layout = job.analysis if number == 1 else job.annotation
        model = F.when(F.col("media_fname").isNotNull(), job.primary_model).otherwise(job.fallback_model)
        scored = score(
            rows.withColumn("model", model).withColumnRenamed(POS, "k"),
            lambda spread: call_requests(spread, number, prompt, response_schema(layout)),
            self.client,
            job.retry,
            job.primary_model,
            job.fallback_model,
            job.score_partitions or max(1, -(-count // job.rows_per_task)),
            job.log_path,
            self.known,
            stop_early=job.stop_on_primary_daily_quota and number == 1,
            rate=None if job.requests_per_minute is None else (
                job.requests_per_minute, job.default_requests_per_minute, job.burst_requests
            ),
        )
        self.made += scored.calls
        return outcomes(scored.log)


def known_calls(queue: Queue, job: JobConfig) -> DataFrame | None:
    """What the log knows of the queued keys; None if nothing. The log is read once per run, and only
    the buckets of the queued keys."""
    spark = queue.ordered.table.sparkSession
    log = read_attempts(spark, job.log_path, keys=queue.ordered.table, buckets=job.log_buckets)
    if log is None:
        return None
    found = reusable(log, queue.ordered.table, errors=not job.retry_errors)
    known, seen = write_observed(found, "known", rows=F.count("*"))
    return known if seen["rows"] else None


def first_pass(rows: DataFrame, count: int, calls: _Calls) -> tuple[DataFrame, int | None]:
    """Rows with ``analysis``, ``err`` and ``model_used``, and the position to stop at, if any."""
    job = calls.job
    wanted = rows.filter(F.col("url_used") != "None").select(
        POS, KEY, "call_url", "save_name", "media_fname", "media_path", "mime"
    )
    settled = calls.outcomes(wanted, count, 1, F.lit(job.prompt))
    paired = rows.join(settled.withColumnRenamed("k", POS), POS, "left")
    flag = quota_flag(F.col("err"), F.col("model_used"), job.primary_model)
    stop = F.when(flag & F.lit(job.stop_on_primary_daily_quota), F.col(POS))
    scored = with_analysis(paired, schema_spec(job.analysis)).drop("resp")
    table, seen = write_observed(scored, "first", stop=F.min(stop))
    return table, seen["stop"]


def second_pass(rows: DataFrame, count: int, calls: _Calls) -> DataFrame:
    """Result rows with annotation columns."""
    job = calls.job
    gate = annotation_gate(
        F.col("analysis"), schema_spec(job.analysis), True, job.annotation_criteria, job.annotation_rules
    )
    work = (POS, "analysis", *ROUTE_COLUMNS)
    prompt = second_prompt(rows, job.annotation_template, KEY, job.annotation_prompt, drop=work)
    settled = calls.outcomes(second_pass_rows(rows, gate), count, 2, prompt)
    replies = with_analysis(settled, schema_spec(job.annotation)).withColumnRenamed("analysis", "reply")
    return annotate(rows, replies, POS, job.annotation_columns, drop=work)


def chunk_bounds(total: int, most: int, first_wave: int = 0) -> list[tuple[int, int]]:
    """(start, size) of the chunks of a queue of ``total`` rows: ``most`` rows each, or waves that double from ``first_wave``."""
    out, start, size = [], 0, (min(first_wave, most) if first_wave > 0 else most)
    while start < total:
        out.append((start, size))
        start += size
        size = min(2 * size, most)
    return out


def run_queue(queue: Queue, job: JobConfig, client: ClientFactory, fresh_keys: bool = False) -> RunReport:
    """Score and append every chunk, up to the first daily quota error of the primary model.

    With ``fresh_keys`` the caller vouches that no queued key was ever called, so the log is not read.
    """
    spec = schema_spec(job.analysis)
    names = annotation_column_names(job.annotation_columns) if job.annotation else []
    columns = column_order(queue.source_columns, result_columns(spec, names))
    work = tuple(c for c in (POS, "analysis", *ROUTE_COLUMNS) if c not in queue.source_columns)
    written, sink = 0, _Sinks(job, names)
    calls = _Calls(job, client, None if fresh_keys else known_calls(queue, job))
    for start, size in chunk_bounds(queue.count, job.commit_rows, job.first_wave_rows):
        with scratch_scope(queue.ordered.table.sparkSession):
            count = min(size, queue.count - start)
            chunk = queue.ordered.slice(start, start + count, POS)
            scored, stop = first_pass(chunk, count, calls)
            if stop is not None:
                # Replies behind the stop stay in the log; the next run uses them.
                scored = scored.filter(F.col(POS) <= stop)
            results = result_rows(scored, queue.source_columns, spec, keep=work)
            if job.annotation:
                results = second_pass(results, count, calls)
            written += sink.append(project_to(results, columns))
            # The chunk is committed: its rounds of calls become one file per key bucket.
            merge_rounds(queue.ordered.table.sparkSession, job.log_path, job.log_buckets, job.log_small_file_bytes)
        if stop is not None:
            return RunReport(queue.count, written, calls.made, stop)
    return RunReport(queue.count, written, calls.made)


class _Sinks:
    """The results table and its copies: mirror and annotation table.

    With copies, each chunk is staged once and goes through the commit ledger (``sinks.ledger``): results
    first, since a run goes by their keys, then the annotation table and the mirror, each marked when
    written. What a crash left out is completed from the staged chunk when the next run starts
    (``repair_copies``). ``job.commit_progress(chunk, step, rows)`` hears of every step.
    """

    def __init__(self, job: JobConfig, names: list[str]):
        self.job, self.names = job, names
        # Read once; appends of this run add to it.
        self.schema: StructType | None = None
        self.asked = False

    def tables(self) -> list[str]:
        job = self.job
        return ["results", *(["annotations"] if self.names and job.annotations_path else []), *(["mirror"] if job.mirror_path else [])]

    def append(self, rows: DataFrame) -> int:
        """Append to every table. With more than one the rows are staged once and the appends read that."""
        job = self.job
        if len(self.tables()) == 1:
            seen = Observation()
            append_results(rows.observe(seen, F.count("*").alias("rows")), job.results_path, job.append_chunk_size)
            self._progress("", "results", seen.get["rows"])
            return seen.get["rows"]
        seen = Observation()
        ledger = Ledger(job.ledger_path)
        chunk, staged = ledger.stage(rows.observe(seen, F.count("*").alias("rows")))
        count = seen.get["rows"]
        self._progress(chunk, "staged", count)
        self.complete(ledger, chunk, staged, count, set(), fresh=True)
        return count

    def complete(self, ledger: Ledger, chunk: str, rows: DataFrame, count: int, done: set[str], fresh: bool = False) -> None:
        """Give every table that lacks it the chunk ``rows``; a table marked ``done`` is skipped.

        Unless the chunk is ``fresh``, only rows that a table does not hold yet (by key and kind of outcome) are added.
        """
        job = self.job
        spark = rows.sparkSession
        good = F.col("vlm_error").isNull()
        paths = {"results": job.results_path, "mirror": job.mirror_path}
        for table in self.tables():
            if table in done:
                continue
            if table == "annotations":
                picked = rows
                if not fresh:
                    held = read_results(spark, job.annotations_path)
                    if held is not None and KEY not in held.columns:
                        # An own annotation_rows without the content key: the table cannot be compared.
                        picked = None
                    else:
                        picked = missing_rows(rows, held, [KEY])
                if picked is not None:
                    self.annotations(picked)
            else:
                picked = rows
                if not fresh:
                    held = read_results(spark, paths[table])
                    picked = missing_rows(rows.withColumn("_good", good), None if held is None else held.withColumn("_good", good),
                                          [KEY, "_good"]).drop("_good")
                append_results(picked.select(*rows.columns), paths[table], job.append_chunk_size)
            ledger.mark(spark, chunk, table)
            self._progress(chunk, table, count)
        ledger.close(spark, chunk, count, self.tables())
        self._progress(chunk, "closed", count)

    def _progress(self, chunk: str, step: str, rows: int) -> None:
        if self.job.commit_progress is not None:
            self.job.commit_progress(chunk, step, rows)

    def annotations(self, rows: DataFrame) -> None:
        job = self.job
        if not self.asked:
            self.schema, self.asked = annotation_schema(rows.sparkSession, job.annotations_path), True
        picked = annotation_rows(rows, self.names, job.annotation_rows, job.annotation_headers)
        self.schema = append_annotations(picked, job.annotations_path, self.schema)


def repair_copies(spark: SparkSession, job: JobConfig) -> list[str]:
    """Complete the chunks that an interrupted run staged but did not bring to every table; returns their names.

    A clean start lists the ledger's staged folder and reads nothing else. An annotation table without the
    content key (own ``annotation_rows``) cannot be compared and is left as it is.
    """
    names = annotation_column_names(job.annotation_columns) if job.annotation else []
    sinks = _Sinks(job, names)
    if len(sinks.tables()) == 1:
        return []
    ledger = Ledger(job.ledger_path)
    repaired = []
    for chunk in ledger.open_chunks(spark):
        rows = ledger.rows(spark, chunk)
        if rows is None:
            ledger.drop(spark, chunk)
            continue
        sinks.complete(ledger, chunk, rows, rows.count(), ledger.marks(spark, chunk))
        repaired.append(chunk)
    return repaired


def run_job(
    posts: DataFrame,
    job: JobConfig,
    client: ClientFactory,
    manifest: DataFrame | None = None,
    failures: DataFrame | None = None,
    post_count: int | None = None,
    repair: bool = True,
    fresh_keys: bool = False,
) -> RunReport:
    """One run over ``posts``: skip what the results table has, score the rest.

    ``post_count``, where known, lets a small batch skip the shuffle of a large results table.
    ``repair`` first completes the copies of the results that an interrupted run left behind.
    ``fresh_keys``: the caller vouches that no key of ``posts`` is in the results or the log (a stream's
    state does), so neither is read.
    """
    spark = configure(posts.sparkSession)
    for path in (job.results_path, job.mirror_path, job.annotations_path, job.log_path):
        if path:
            shared_path(spark, path)
    if repair:
        repair_copies(spark, job)
    done = processed_keys(spark, job.results_path, job.retry_errors) if not fresh_keys else spark.createDataFrame([], f"{KEY} string")
    if not fresh_keys and post_count is not None and post_count <= SMALL_BATCH:
        done = keys_among(done, with_content_key(posts, job.key_columns))
    with scratch_scope(spark):
        queue = prepare(posts, done, job, manifest, failures)
        return run_queue(queue, job, client, fresh_keys) if queue else RunReport(0, 0, False)


def run_project(spark: SparkSession, job: JobConfig, client: ClientFactory) -> RunReport:
    """``run_job`` over the job's own input path and media folder."""
    options = {"multiline": job.multiline_csv} if job.input_path.rstrip("/").endswith(".csv") else {}
    return run_job(read_posts(configure(spark), job.input_path, job.ordinal, **options), job, client)
