"""One registered query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossa.config import RetryPolicy
from glossa.functions import errors, prompts, reply, text
from glossa.functions.cells import cell_text, json_text
from glossa.operators import attempts, gate, media, positions, queue, quota, rate, results
from glossa.operators.annotate import annotate, second_pass_rows, second_prompt
from glossa.plans import prepare as plans
from glossa.plans.run import chunk_bounds, run_job
from glossa.plans.scoring import per_row_client
from glossa.schema_spec import schema_spec
from glossa.session import configure, scratch_path, write_scratch
from glossa.sinks.ledger import Ledger
from glossa.sinks.tables import annotation_rows, append_by_name, append_results
from glossa.sources.attempts import (
    LOG_BUCKETS, append_attempts, log_bucket, merge_rounds, read_attempts, response_text, round_folders,
)
from glossa.sources.posts import CSV_OPTIONS, read_csv
from glossa.sources.results import read_results
from glossa.streaming.incremental import annotate_stream
from suite.schemas import JOB, PROMPT, TEMPLATE, Note, Prior, Scene
from suite.stub import stub_client
from suite.views import table, view

Query = Callable[[SparkSession, str], DataFrame]

POLICY = RetryPolicy()
ANALYSIS, NOTE, PRIOR = schema_spec(Scene), schema_spec(Note), schema_spec(Prior)
KEY = queue.KEY

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register ``fn`` under its name, less the underscore that keeps it off an import."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return fn


def keyed_posts(spark: SparkSession, sf: str) -> DataFrame:
    return queue.with_content_key(view(spark, sf, "posts"), JOB.key_columns)


def earlier_results(spark: SparkSession, sf: str) -> DataFrame:
    """A results table of every third post, with padded, blank and missing keys between."""
    n = F.col("ordinal") % 6
    key = (
        F.when(n == 0, F.col(KEY)).when(n == 3, F.concat(F.lit(" "), F.col(KEY), F.lit("\t")))
        .when(n == 1, F.lit("  "))
    )
    return write_scratch(keyed_posts(spark, sf).select(key.alias(KEY), "platform"), "earlier")


# ---------------------------------------------------------------- sources and scalars


@query
def scan_posts(spark, sf):
    """Posts written as CSV (multi-line HTML, quotes, blanks) and read back."""
    pages = table(spark, sf, "pages").select(F.col("page_id").alias("ordinal"), "html")
    posts = view(spark, sf, "posts").join(pages, "ordinal")
    path = scratch_path(spark, "csv")
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    posts.write.mode("append").options(**CSV_OPTIONS, **keep).csv(path)
    return read_csv(spark, path, types={"ordinal": "bigint"})


@query
def clean_text(spark, sf):
    return view(spark, sf, "posts").select(
        "ordinal",
        *[text.clean_text(F.col(c)).alias(c) for c in ("post_url", "media_url", "platform")],
    )


@query
def normalize_url(spark, sf):
    return view(spark, sf, "posts").select(
        "ordinal", text.normalize_url(F.col("post_url")).alias("post_url"),
        text.clean_url(F.col("post_url")).alias("post_url_clean"),
    )


@query
def content_key(spark, sf):
    return keyed_posts(spark, sf).select("ordinal", KEY)


@query
def media_save_name(spark, sf):
    url = F.col("media_url")
    return view(spark, sf, "posts").select(
        "ordinal",
        text.media_save_name(text.clean_url(F.col("post_url")), "post").alias("post_name"),
        text.media_save_name(url, "media").alias("media_name"),
    )


@query
def host_family(spark, sf):
    posts = view(spark, sf, "posts")
    return posts.select("ordinal", *[text.host_family(F.col(c)).alias(c) for c in ("post_url", "media_url")])


@query
def mime_type(spark, sf):
    files = view(spark, sf, "manifest").select("fname", text.mime_type(F.col("fname")).alias("mime"))
    urls = view(spark, sf, "posts").select(
        F.col("media_url").alias("fname"), text.mime_type(F.col("media_url")).alias("mime")
    )
    return files.unionByName(urls)


@query
def clip_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clip_text(F.col("text")).alias("clipped"))


@query
def download_error(spark, sf):
    docs = table(spark, sf, "documents")
    image = F.concat(text.clip_text(F.col("text")), F.lit(" | "), text.url_context(F.col("text")))
    return docs.select("doc_id", text.download_error(F.col("source"), image).alias("message"))


# ---------------------------------------------------------------- queue


@query
def dedup_first(spark, sf):
    return queue.dedup_first(view(spark, sf, "posts"))


@query
def processed_keys(spark, sf):
    return queue.distinct_keys(earlier_results(spark, sf))


@query
def pending(spark, sf):
    posts = view(spark, sf, "posts")
    return plans.pending_posts(posts, queue.distinct_keys(earlier_results(spark, sf)), JOB)


@query
def sorted_queue(spark, sf):
    posts = view(spark, sf, "posts")
    order = queue.sort_order(posts, ["platform", "absent", "media_url"], [True, True, False])
    return positions.with_position(posts, order)


@query
def batch_pos(spark, sf):
    rows = plans.pending_posts(
        view(spark, sf, "posts"), queue.distinct_keys(earlier_results(spark, sf)), JOB
    )
    order = queue.sort_order(rows, JOB.sort_columns, JOB.sort_ascending)
    return positions.with_position(rows, order).select("pos", "ordinal", KEY)


@query
def top_per_group(spark, sf):
    posts = queue.dedup_first(view(spark, sf, "posts"))
    return queue.top_per_group(posts, "platform", 2, queue.sort_order(posts, ["platform"], [True]))


@query
def top_per_group_large(spark, sf):
    """A cap above what Spark cuts before the shuffle."""
    posts = view(spark, sf, "bulk_posts")
    order = queue.sort_order(posts, ["platform", "likes"], [True, False])
    return queue.top_per_group(posts, "platform", 5000, order)


@query
def limit_n(spark, sf):
    posts = view(spark, sf, "posts")
    return queue.first_rows(posts, 20, queue.sort_order(posts, ["media_url"], [False]))


@query
def shuffled(spark, sf):
    rows = keyed_posts(spark, sf)
    return positions.with_position(rows, queue.shuffle_order(KEY, "ordinal", "7")).select("pos", "ordinal")


@query
def chunk_ids(spark, sf):
    posts = view(spark, sf, "bulk_posts")
    placed = positions.with_position(posts, queue.sort_order(posts, ["platform"], [True]))
    return positions.chunk_ids(placed, "pos", 100).select("ordinal", "pos", "chunk_id")


@query
def bulk_queue(spark, sf):
    """The whole queue on a larger table where one URL holds about a third of the rows."""
    posts = view(spark, sf, "bulk_posts")
    done = write_scratch(queue.with_content_key(posts.filter("likes > 45"), JOB.key_columns).select(KEY), "earlier")
    rows = plans.queue_rows(posts, queue.distinct_keys(done), JOB.with_(rows_per_platform=500))
    return rows.groupBy("platform").agg(
        F.count("*").alias("n_rows"), F.min("ordinal").alias("first"), F.max("ordinal").alias("last"),
        F.min(KEY).alias("min_key"),
    )


# ---------------------------------------------------------------- media and routes


@query
def media_resolve(spark, sf):
    manifest = view(spark, sf, "manifest")
    names = table(spark, sf, "pages").select(
        "page_id", F.concat(F.lit("s"), F.col("page_id") % 50).alias("save_name")
    )
    return media.join_by_name(names, media.resolve_media(manifest), "page_id").drop("media_path")


def posts_table(spark: SparkSession, sf: str) -> DataFrame:
    """The posts as a table on disk, with what ``dispatch_url`` and ``with_content_key`` add."""
    return write_scratch(media.dispatch_url(keyed_posts(spark, sf)), "posts")


def store(posts: DataFrame) -> DataFrame:
    """Media files for two thirds of the posts, some of them empty."""
    suffix = F.when(F.col("ordinal") % 2 == 0, ".mp4").otherwise(".jpg")
    return posts.filter("save_name is not null and ordinal % 3 <> 0").select(
        "save_name", F.concat("save_name", suffix).alias("fname"), (F.col("ordinal") % 7).alias("size")
    )


def failures(posts: DataFrame) -> DataFrame:
    return posts.filter("save_name is not null and ordinal % 5 <> 0").select(
        "save_name", F.lit("no video").alias("video_error"),
        F.concat(F.lit("exit 1 | "), text.url_context(F.col("call_url"))).alias("image_error"),
    )


def routed_posts(spark: SparkSession, sf: str) -> DataFrame:
    posts = posts_table(spark, sf)
    rows = posts.drop("call_url", "url_role", "save_name")
    return plans.with_media(rows, JOB, store(posts), failures(posts))


@query
def url_dispatch(spark, sf):
    return routed_posts(spark, sf).select(
        "ordinal", "url_used", "call_url", "save_name", "media_fname", "mime", "download_error"
    )


# ---------------------------------------------------------------- errors and attempts


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "attempts").select("k", "attempt", "err")


@query
def error_class(spark, sf):
    return errors.with_error_class(messages(spark, sf)).drop("err", "delay_sec")


@query
def retry_delay(spark, sf):
    return messages(spark, sf).select("k", "attempt", errors.retry_delay(F.col("err")).alias("delay_sec"))


@query
def attempt_log(spark, sf):
    return attempts.with_reply_error(view(spark, sf, "calls"))


@query
def attempt_outcome(spark, sf):
    log = attempts.with_reply_error(view(spark, sf, "attempts"))
    return attempts.resolve_attempts(log, POLICY, ["k"])


@query
def retry_wait(spark, sf):
    log = attempts.with_reply_error(view(spark, sf, "attempts"))
    return attempts.planned_wait(log, POLICY, ["k"])


@query
def fallback_decision(spark, sf):
    log = attempts.with_reply_error(view(spark, sf, "calls"))
    return attempts.decide(log, POLICY, "primary", "fallback")


@query
def quota_stop(spark, sf):
    """Every event is a queued row; none of the first 40 was called. The first daily error ends the queue."""
    rows = table(spark, sf, "events").select(F.col("event_id").alias("pos"), "user_id")
    log = view(spark, sf, "calls").select(
        (F.col("k") * 6 + F.when(F.col("model") == "primary", 0).otherwise(3) + F.col("attempt") + 40).alias("pos"),
        "model", "err",
    )
    joined = rows.join(log, "pos", "left")
    flag = quota.quota_flag(F.col("err"), F.col("model"), "primary")
    return quota.stop_at_quota(joined, "pos", flag)


# ---------------------------------------------------------------- replies


@query
def text_parts(spark, sf):
    """Each turn as a response: its lines are candidates, their words parts."""
    candidates = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    return view(spark, sf, "responses").select("conv_id", "turn", reply.reply_text(candidates).alias("resp"))


@query
def saved_responses(spark, sf):
    """Raw JSON responses, as an API returns them, read back to reply texts."""
    part = F.struct(F.struct(F.array(F.struct(F.col("text")), F.struct(F.col("role").alias("text")))
                             .alias("parts")).alias("content"))
    raw = F.to_json(F.struct(F.array(part).alias("candidates")))
    saved = table(spark, sf, "conversations").select("conv_id", "turn", raw.alias("response"))
    return response_text(saved).select("conv_id", "turn", "resp")


def parsed_replies(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "replies").withColumn("v", reply.parse_reply_json(F.col("resp")))


@query
def reply_status(spark, sf):
    resp, v = F.col("resp"), F.col("v")
    return parsed_replies(spark, sf).select(
        "k", reply.reply_status(resp, v).alias("status"), reply.reply_error(resp, v).alias("error")
    )


def typed_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Replies with a null ``resp`` where there is no object."""
    ok = reply.reply_status(F.col("resp"), F.col("v")) == "ok"
    good = parsed_replies(spark, sf).withColumn("resp", F.when(ok, F.col("resp")))
    return results.with_analysis(good, ANALYSIS, parsed="v").drop("v")


@query
def parse_reply(spark, sf):
    a = F.col("analysis")
    return typed_replies(spark, sf).select(
        "k", a.isNotNull().alias("ok"), "analysis.mood", "analysis.caption",
        "analysis.score", "analysis.indoors", F.array_join("analysis.objects", ",").alias("objects"),
        a["spot"]["country"].alias("country"), a["spot"]["city"].alias("city"), "analysis.lang",
    )


@query
def enum_coerce(spark, sf):
    raw, levels = F.col("event_type"), ("SIGNUP", "PURCHASE", "ERROR", "view")
    own = ("CLICK", "view", "GRIM")
    return table(spark, sf, "events").select(
        "event_id",
        reply.enum_value(raw, own).alias("coerced"),
        reply.enum_fell_back(raw, own).alias("fell_back"),
        reply.enum_value(raw, levels).alias("level"),
    )


@query
def bool_coerce(spark, sf):
    raw = F.to_json(F.try_variant_get("v", "$[0].indoors", "variant"))
    return parsed_replies(spark, sf).select("k", reply.truth_value(raw).alias("indoors"))


@query
def full_json(spark, sf):
    # Counting the replies keeps the filter above the parse; pushed below, it would parse them again.
    replies = typed_replies(spark, sf).observe("replies", F.count("*").alias("rows"))
    return replies.filter("analysis is not null").select("k", json_text(F.col("analysis")).alias("json"))


# ---------------------------------------------------------------- gates and prompts


@query
def annotation_gate(spark, sf):
    a = F.struct("mood", "indoors", "quality", "caption")
    rules = {
        "by_enum": {"mood": "CALM"},
        "by_bool": {"indoors": True},
        "by_both": {"mood": "festive", "indoors": False},
        "by_number": {"quality": 1},
        "by_text": {"caption": "because"},
        "by_truth": {"caption": True},
        "by_unknown": {"nothing": 1},
    }
    rows = view(spark, sf, "analyses")
    return rows.select(
        "doc_id",
        *[gate.annotation_gate(a, PRIOR, rules=r).alias(n) for n, r in rules.items()],
        gate.annotation_gate(a, PRIOR).alias("by_default"),
        gate.annotation_gate(a, PRIOR, criteria=lambda x: x["quality"] == 0).alias("by_criteria"),
        gate.annotation_gate(a, PRIOR, enabled=False).alias("off"),
    )


@query
def prompt_first(spark, sf):
    has_media = F.col("media_fname").isNotNull()
    prompt = F.when(has_media, prompts.media_prompt(F.lit(PROMPT), F.col("call_url"))).otherwise(
        prompts.url_prompt(F.lit(PROMPT), F.col("call_url"))
    )
    return routed_posts(spark, sf).select("ordinal", prompt.alias("prompt"))


@query
def prompt_annotation(spark, sf):
    work = (*plans.ROUTE_COLUMNS, "resp", "err", "model_used")
    rows = scored_posts(spark, sf)
    wanted = second_pass_rows(rows, F.col("analysis").isNotNull())
    return wanted.select("ordinal", second_prompt(rows, TEMPLATE, drop=work).alias("prompt"))


# ---------------------------------------------------------------- results


def routed_log(spark: SparkSession, sf: str, posts: DataFrame, shift: int = 0) -> DataFrame:
    """Attempt log of the posts; posts without media have fallback calls only."""
    log = view(spark, sf, "calls").withColumn("k", F.col("k") + shift)
    routes = posts.select(F.col("ordinal").alias("k"), "url_used")
    wanted = F.col("url_used").isin("post", "media") | (
        (F.col("url_used") == "url") & (F.col("model") == "fallback")
    )
    return attempts.with_reply_error(log.join(routes, "k").filter(wanted).drop("url_used"))


def scored_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicated posts with the outcome of their calls and the typed reply."""
    posts = write_scratch(routed_posts(spark, sf), "routed")
    batch = queue.dedup_first(posts)
    outcomes = attempts.decide(routed_log(spark, sf, posts), POLICY, "primary", "fallback")
    paired = batch.join(
        outcomes.select(F.col("k").alias("ordinal"), "resp", "err", "model_used"), "ordinal", "left"
    )
    return results.with_analysis(paired, ANALYSIS)


SOURCE = ["ordinal", "post_url", "media_url", "platform", KEY]
FLAT = ["vlm_score", "vlm_indoors", "vlm_lang"]


def post_results(spark: SparkSession, sf: str) -> DataFrame:
    return results.result_rows(scored_posts(spark, sf), SOURCE, ANALYSIS, keep=("analysis", "media_fname"))


@query
def first_pass(spark, sf):
    return scored_posts(spark, sf).select(
        "ordinal", KEY, "url_used", "model_used", "err", F.col("analysis").isNotNull().alias("has_analysis")
    )


@query
def result_ok(spark, sf):
    rows = post_results(spark, sf).filter("vlm_error is null")
    return rows.drop("analysis", "media_fname", "vlm_processed_at", "vlm_objects", "vlm_spot")


@query
def result_error(spark, sf):
    rows = post_results(spark, sf).filter("vlm_error is not null")
    return rows.select("ordinal", KEY, "vlm_url_used", "vlm_model_used", "vlm_error",
                       "vlm_download_error_before_url", "vlm_mood", "vlm_full_response_json")


def annotated_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Second pass on posts judged FESTIVE or LIVELY by rule, on their own calls."""
    rows = write_scratch(post_results(spark, sf), "results")
    chosen = gate.annotation_gate(
        F.col("analysis"), ANALYSIS, criteria=lambda a: a["mood"].isin("FESTIVE", "LIVELY")
    )
    wanted = second_pass_rows(rows, chosen).select("ordinal", "vlm_url_used")
    log = routed_log(spark, sf, wanted.withColumnRenamed("vlm_url_used", "url_used"), shift=1)
    outcomes = attempts.decide(log, POLICY, "primary", "fallback")
    typed = results.with_analysis(outcomes, NOTE).withColumnRenamed("analysis", "reply")
    return annotate(rows, typed, "ordinal")


@query
def annotate_(spark, sf):
    return annotated_posts(spark, sf).select("ordinal", *results.ANNOTATION_COLUMNS)


@query
def annotation_sink_rows(spark, sf):
    return annotation_rows(annotated_posts(spark, sf), results.ANNOTATION_COLUMNS)


@query
def column_order(spark, sf):
    """Columns in output order, one of them absent, shown as joined text."""
    posts = keyed_posts(spark, sf).withColumn("vlm_b", F.lit("b")).withColumn("extra", F.lit("dropped"))
    source = ["vlm_b", "platform", KEY, "ordinal", "media_url"]
    wanted = results.column_order(source, ["vlm_error", "vlm_a", KEY])
    rows = results.project_to(posts.withColumn("vlm_a", F.lit("a")), wanted)
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in rows.columns]
    return rows.select("ordinal", F.concat_ws("|", *shown).alias("row_text"))


@query
def header_reconcile(spark, sf):
    existing = view(spark, sf, "posts").select("ordinal", "platform", "post_url")
    new = table(spark, sf, "pages").select(
        F.col("url"), (F.col("page_id") + 1_000_000_000).alias("ordinal"), F.lit("web").alias("platform")
    )
    rows = append_by_name(existing, new)
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in rows.columns]
    return rows.select("*", F.concat_ws("|", *shown).alias("row_text"))


@query
def cell_text_(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "ts", "value", (F.col("value") * 1e7).alias("large"),
        (F.col("value") / 1e5).alias("small"), (F.col("value") > 20).alias("big"),
        F.when(F.col("event_id") % 3 > 0, F.col("props")).alias("props"),
    )
    return rows.select(
        "event_id",
        *[cell_text(F.col(f.name), f.dataType).alias(f"{f.name}_text") for f in rows.schema[1:]],
    )


@query
def run_summary(spark, sf):
    return results.run_summary(post_results(spark, sf))


# ---------------------------------------------------------------- sinks, resume, stream


def _written(spark: SparkSession, sf: str) -> DataFrame:
    return post_results(spark, sf).drop("analysis", "media_fname", "vlm_processed_at")


@query
def sink_roundtrip(spark, sf):
    """Results appended twice, the second time with a new column, then read by name."""
    rows = _written(spark, sf)
    path = scratch_path(spark, "results") + "/table"
    append_results(rows.filter("ordinal % 2 = 0"), path)
    append_results(rows.filter("ordinal % 2 = 1").withColumn("vlm_note", F.lit("new")), path)
    return read_results(spark, path).select("ordinal", KEY, "vlm_error", *FLAT, "vlm_note", "vlm_spot.city")


@query
def mirror_sink(spark, sf):
    """The same rows in a Parquet table and a CSV mirror."""
    folder = scratch_path(spark, "mirror")
    primary, mirror = f"{folder}/results", f"{folder}/results.csv"
    append_results(_written(spark, sf), primary)
    append_results(spark.read.parquet(primary), mirror)
    columns = ["ordinal", "platform", KEY, "vlm_error", "vlm_full_response_json", "vlm_indoors"]
    first = read_results(spark, primary).select(*[F.col(c).cast("string") for c in columns])
    second = read_results(spark, mirror).select(*columns)
    second = second.withColumn("vlm_indoors", F.lower("vlm_indoors"))
    return first.withColumn("sink", F.lit("primary")).unionByName(second.withColumn("sink", F.lit("mirror")))


@query
def log_compaction(spark, sf):
    """Every call of ``calls`` logged as a round per attempt, merged at commit, and read back per key bucket.

    A second merge finds nothing to do; every bucket is one file, no round is left, and no row is lost or doubled.
    """
    calls = view(spark, sf, "calls")
    log = calls.select(
        "k", F.sha2(F.col("k").cast("string"), 256).alias(KEY), F.col("pass").cast("int").alias("pass"), "model",
        F.col("attempt").cast("int").alias("attempt"), F.lit("p").alias("prompt_hash"), F.lit(True).alias("called"),
        F.col("attempt").cast("double").alias("ended_at"), "resp", "err",
    )
    path = scratch_path(spark, "log") + "/log"
    for attempt in range(3):
        append_attempts(log.filter(F.col("attempt") == attempt), path)
    first = merge_rounds(spark, path, LOG_BUCKETS)
    again = merge_rounds(spark, path, LOG_BUCKETS)
    left = len(round_folders(spark, path)) + again.rounds + again.files_read
    read = read_attempts(spark, path).withColumn("_file", F.input_file_name())
    return read.groupBy(log_bucket(F.col(KEY), LOG_BUCKETS).alias("bucket")).agg(
        F.countDistinct("_file").alias("n_files"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct(KEY).alias("n_keys"),
        F.count("resp").alias("n_replies"), F.count("err").alias("n_errors"),
        F.lit(first.rounds).cast("long").alias("rounds_merged"), F.lit(left).cast("long").alias("left_over"),
    )


RATE_LIMITS = {"primary": 7, "fallback": 5}


@query
def rate_schedule(spark, sf):
    """A planned start for every call of ``calls``: seven a minute on the primary model, five on the fallback, three more at first."""
    calls = view(spark, sf, "calls").select("k", "model", "attempt", (F.col("k") * 3 + F.col("attempt")).alias("place"))
    planned = rate.rate_schedule(calls, "place", "model", RATE_LIMITS, 1, burst=3)
    return planned.select("k", "model", "attempt", "rate_rank", "ready_at")


def _job(path: str, **changes):
    return JOB.with_(results_path=path, **changes)


@query
def resume_run(spark, sf):
    """A capped run, a run over the rest in chunks, and a third that finds nothing to do."""
    known = posts_table(spark, sf)
    posts, manifest = known.select("ordinal", *JOB.key_columns), store(known)
    path = scratch_path(spark, "resume") + "/table"
    run_job(posts, _job(path, rows_per_platform=3), stub_client(), manifest)
    chunk = max(100, posts.count() // 2)
    run_job(posts, _job(path, commit_rows=chunk), stub_client(), manifest)
    last = run_job(posts, _job(path), stub_client(), manifest)
    return read_results(spark, path).select(
        "ordinal", KEY, "platform", "vlm_url_used", "vlm_model_used", "vlm_mood",
        "vlm_caption", "vlm_error", F.lit(last.queued).cast("long").alias("left_over"),
    )


def _repeated_calls(spark: SparkSession, path: str) -> int:
    """Calls that the log of a run holds more than once."""
    log = read_attempts(spark, f"{path}-attempts").filter("called")
    return log.groupBy(KEY, "pass", "model", "attempt").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]


RUN_COLUMNS = [
    "ordinal", KEY, "platform", "vlm_url_used", "vlm_model_used", "vlm_mood", "vlm_caption", "vlm_error",
]


@query
def resume_after_crash(spark, sf):
    """A run that dies while it retries, and a second one: what was called is not called again."""
    known = posts_table(spark, sf)
    posts, manifest = once_per_key(known.select("ordinal", *JOB.key_columns)), store(known)
    path = scratch_path(spark, "crash") + "/table"

    def dying():
        calls = stub_client()()

        def run(requests):
            if (requests["attempt"] > 0).any():
                raise RuntimeError("the executor is gone")
            return calls(requests)

        return run

    job = _job(path, rows_per_task=20)
    try:
        run_job(posts, job, dying, manifest)
        raise AssertionError("the run was to die")
    except PySparkException:
        pass
    run_job(posts, job, stub_client(), manifest)
    return read_results(spark, path).select(*RUN_COLUMNS, F.lit(_repeated_calls(spark, path)).cast("long").alias("repeated_calls"))


QUOTA_AT = 20


def _quota_run(spark: SparkSession, sf: str):
    """A run whose primary model reports a spent daily quota from position ``QUOTA_AT`` on."""
    known = posts_table(spark, sf)
    posts, manifest = once_per_key(known.select("ordinal", *JOB.key_columns)), store(known)
    path = scratch_path(spark, "quota") + "/table"
    job = _job(path, stop_on_primary_daily_quota=True, rows_per_task=20)
    report = run_job(posts, job, stub_client(daily_after=QUOTA_AT), manifest)
    return posts, manifest, job, report


@query
def run_quota_stop(spark, sf):
    """Rows up to the first one that met the quota, and where that was."""
    _, _, job, report = _quota_run(spark, sf)
    stop = F.lit(report.stopped_at).cast("long").alias("stopped_at")
    return read_results(spark, job.results_path).select(*RUN_COLUMNS, stop)


@query
def quota_waves(spark, sf):
    """A run in waves of 4, 8, 16 ... rows whose primary model meets its daily quota at position 20.

    The rows up to the stop, the stop, and whether the calls made behind it fit in one wave.
    """
    known = posts_table(spark, sf)
    posts, manifest = once_per_key(known.select("ordinal", *JOB.key_columns)), store(known)
    path = scratch_path(spark, "waves") + "/table"
    job = _job(path, stop_on_primary_daily_quota=True, rows_per_task=20, first_wave_rows=4)
    report = run_job(posts, job, stub_client(daily_after=QUOTA_AT), manifest)
    calls = read_attempts(spark, job.log_path).filter("called and pass = 1 and model = 'primary'")
    behind = calls.filter(F.col("k") > report.stopped_at).count() if report.stopped_at is not None else 0
    wave = max(size for start, size in chunk_bounds(10**9, job.commit_rows, 4) if start <= QUOTA_AT < start + size)
    stop = F.lit(report.stopped_at).cast("long").alias("stopped_at")
    return read_results(spark, job.results_path).select(*RUN_COLUMNS, stop, F.lit(behind <= wave).alias("within_one_wave"))


@query
def quota_resume(spark, sf):
    """The next run after a quota stop scores the rest and calls nothing that was answered."""
    posts, manifest, job, _ = _quota_run(spark, sf)
    run_job(posts, job, stub_client(), manifest)
    answered = read_attempts(spark, job.log_path).filter("called and err is null")
    twice = answered.groupBy(KEY, "pass", "model", "attempt").count().filter("count > 1").count()
    return read_results(spark, job.results_path).select(*RUN_COLUMNS, F.lit(twice).cast("long").alias("answered_twice"))


def two_pass_client():
    """First pass as the stub; second pass says what it was asked about."""
    first = stub_client()
    # Made here: tasks cannot import the package.
    second = per_row_client(lambda r: {"caption": r["call_url"], "lang": r["media_path"], "indoors": True})

    def factory():
        answer_first, answer_second = first(), second()

        def run(requests):
            return answer_first(requests) if (requests["pass"] == 1).all() else answer_second(requests)

        return run

    return factory


def _two_pass_job(path: str, **changes):
    return _job(
        path, annotation=Note, annotation_template=TEMPLATE, annotation_rules={"mood": "festive"}, media_dir="s3a://media/store",
        annotations_path=f"{path}-annotations", mirror_path=f"{path}-mirror.csv", **changes,
    )


@query
def run_two_pass(spark, sf):
    """Both passes through a whole run: festive scenes get a second call about their media."""
    known = posts_table(spark, sf)
    posts, manifest = known.select("ordinal", *JOB.key_columns), store(known)
    job = _two_pass_job(scratch_path(spark, "passes") + "/table")
    run_job(posts, job, two_pass_client(), manifest)
    counts = {
        name: read_results(spark, path).count()
        for name, path in (("n_annotations", job.annotations_path), ("n_mirror", job.mirror_path))
    }
    return read_results(spark, job.results_path).select(
        "ordinal", KEY, "vlm_mood", "vlm_error", *results.ANNOTATION_COLUMNS,
        *[F.lit(n).cast("long").alias(name) for name, n in counts.items()],
    )


@query
def commit_repair(spark, sf):
    """A driver lost between the writes of a commit; the next run completes the copies."""
    known = posts_table(spark, sf)
    posts, manifest = known.select("ordinal", *JOB.key_columns), store(known)
    path = scratch_path(spark, "repair") + "/table"

    def lost(rows):
        raise ConnectionError("the driver is gone")

    try:
        run_job(posts, _two_pass_job(path, annotation_rows=lost), two_pass_client(), manifest)
        raise AssertionError("the run was to die")
    except ConnectionError:
        pass
    job = _two_pass_job(path)
    run_job(posts, job, two_pass_client(), manifest)
    parts = [
        read_results(spark, p).select(KEY, F.lit(name).alias("sink"))
        for name, p in (("results", path), ("mirror", job.mirror_path), ("annotations", job.annotations_path))
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("sink", KEY).agg(F.count("*").alias("n_rows"))


COMMIT_STEPS = ("staged", "results", "annotations", "mirror")


@query
def commit_ledger(spark, sf):
    """A driver lost after each step of a commit in turn; the next run completes the chunk from the ledger.

    Per step, each table's rows by key: every key once in results and mirror, festive ones once in the annotation
    table, and no chunk left open.
    """
    known = posts_table(spark, sf)
    posts, manifest = known.select("ordinal", *JOB.key_columns), store(known)
    parts = []
    for step in COMMIT_STEPS:
        path = scratch_path(spark, f"ledger-{step}") + "/table"

        def lose(chunk, done, rows, step=step):
            if done == step:
                raise ConnectionError("the driver is gone")

        try:
            run_job(posts, _two_pass_job(path, commit_progress=lose), two_pass_client(), manifest)
            raise AssertionError("the run was to die")
        except ConnectionError:
            pass
        job = _two_pass_job(path)
        run_job(posts, job, two_pass_client(), manifest)
        left = len(Ledger(job.ledger_path).open_chunks(spark))
        for name, p in (("results", path), ("mirror", job.mirror_path), ("annotations", job.annotations_path)):
            parts.append(read_results(spark, p).select(KEY, F.lit(name).alias("sink"), F.lit(step).alias("lost_after"),
                                                       F.lit(left).cast("long").alias("open_chunks")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("lost_after", "sink", KEY, "open_chunks").agg(F.count("*").alias("n_rows"))


@query
def media_lookup(spark, sf):
    """Files of a store on disk, looked up by the names of the queue."""
    root = scratch_path(spark, "media")
    files = posts_table(spark, sf).filter("save_name is not null and ordinal % 3 < 2").select(
        "save_name", F.concat("save_name", F.when(F.col("ordinal") % 2 == 0, ".mp4").otherwise("_1.jpg")).alias("fname")
    ).distinct()

    def write(batches):
        from pathlib import Path

        for batch in batches:
            for name, fname in zip(batch["save_name"], batch["fname"]):
                folder = Path(root.removeprefix("file://").removeprefix("file:")) / name
                folder.mkdir(parents=True, exist_ok=True)
                (folder / fname).write_bytes(b"x")
            yield batch

    write_scratch(files.mapInPandas(write, files.schema), "written")
    job = _job("", media_dir=root)
    rows = plans.with_media(posts_table(spark, sf).select("ordinal", *JOB.key_columns), job, None)
    place = F.substring("media_path", len(root) + 2, 1000)
    return rows.select("ordinal", "media_fname", place.alias("media_place"), "url_used", "mime")


def once_per_key(posts: DataFrame) -> DataFrame:
    """The first post of each content key."""
    return queue.dedup_first(queue.with_content_key(posts, JOB.key_columns), KEY).drop(KEY)


@query
def stream_resume(spark, sf):
    """Files through the stream, then all again from a fresh checkpoint; rows per key in the end.

    Several URLs of a file, and of different files, share a content key.
    """
    posts = queue.dedup_first(view(spark, sf, "posts"))
    folder = scratch_path(spark, "stream")
    source, path = f"{folder}/in", f"{folder}/results"
    for half in (0, 1):
        posts.filter(F.col("ordinal") % 2 == half).write.mode("append").parquet(source)
    arriving = (
        spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    )
    for attempt in (1, 2):
        annotate_stream(arriving, _job(path), stub_client(), f"{folder}/checkpoint{attempt}").awaitTermination()
    return read_results(spark, path).groupBy(KEY).agg(F.count("*").alias("n_rows"))


@query
def stream_state(spark, sf):
    """One stream over two arrivals, the second repeating every key of the first, then a fresh checkpoint over all.

    The keyed state lets each key through once; the fresh checkpoint starts from the results. Rows per key in the end.
    """
    posts = queue.dedup_first(view(spark, sf, "posts"))
    folder = scratch_path(spark, "state")
    source, path = f"{folder}/in", f"{folder}/results"
    posts.filter(F.col("ordinal") % 2 == 0).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    annotate_stream(arriving, _job(path), stub_client(), f"{folder}/checkpoint", state=True).awaitTermination()
    # Late repeats: the first arrival again, with the rest.
    posts.write.mode("append").parquet(source)
    annotate_stream(arriving, _job(path), stub_client(), f"{folder}/checkpoint", state=True).awaitTermination()
    annotate_stream(arriving, _job(path), stub_client(), f"{folder}/fresh", state=True).awaitTermination()
    return read_results(spark, path).groupBy(KEY).agg(F.count("*").alias("n_rows"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Raw posts, keyed and deduplicated, minus earlier results, capped and counted per platform."""
    configure(spark)
    done = queue.distinct_keys(earlier_results(spark, sf))
    rows = plans.queue_rows(view(spark, sf, "posts"), done, JOB.with_(rows_per_platform=5))
    return rows.groupBy("platform").agg(F.count("*").alias("n_rows"), F.min("ordinal").alias("first"))
