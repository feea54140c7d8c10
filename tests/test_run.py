"""Whole runs: resume, chunks, quota stop, second pass, sinks and hooks."""

from __future__ import annotations

import sys
from dataclasses import dataclass

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa import RetryPolicy, annotate_stream, load_job, per_row_client, run_job, run_project
from glossa.hooks import row_hook
from glossa.operators import attempts
from glossa.operators.queue import KEY
from glossa.sources.attempts import read_attempts, reusable
from glossa.sources.results import processed_keys, read_results
from suite.queries import store
from suite.schemas import JOB as SUITE_JOB
from suite.schemas import TEMPLATE, Note
from suite.stub import stub_client
from suite.views import view

JOB = SUITE_JOB.with_(score_partitions=2)

# Workers cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def posts(spark, sf_dir):
    from glossa.session import write_scratch

    return write_scratch(view(spark, sf_dir, "posts"), "posts")


@pytest.fixture(scope="module")
def manifest(spark, posts):
    from glossa.operators.media import dispatch_url

    return store(dispatch_url(posts))


def rows(spark, path, *columns):
    df = read_results(spark, str(path))
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


SHOWN = ("ordinal", KEY, "vlm_url_used", "vlm_model_used", "vlm_mood", "vlm_error")


def answering(reply):
    return per_row_client(lambda request: reply)


def test_chunks_equal_one_run_and_rerun_finds_nothing(spark, posts, manifest, tmp_path):
    one, many = JOB.with_(results_path=str(tmp_path / "one")), JOB.with_(results_path=str(tmp_path / "many"))
    report = run_job(posts, one, stub_client(), manifest)
    assert report.queued == report.written > 0 and not report.stopped
    run_job(posts, many.with_(commit_rows=17), stub_client(), manifest)
    assert rows(spark, one.results_path, *SHOWN) == rows(spark, many.results_path, *SHOWN)
    again = run_job(posts, one, stub_client(), manifest)
    assert (again.queued, again.written) == (0, 0)


def test_failed_rows_are_done_unless_asked(spark, tmp_path):
    posts = spark.createDataFrame([(1, "u", None, "x"), (2, "v", None, "x")],
                                  "ordinal long, post_url string, media_url string, platform string")
    job = JOB.with_(results_path=str(tmp_path / "r"))

    def fails_on_v(request):
        if request["call_url"] == "v":
            raise RuntimeError("403 no")
        return "{}"

    assert run_job(posts, job, per_row_client(fails_on_v)).written == 2
    assert run_job(posts, job, answering("{}")).queued == 0
    assert run_job(posts, job.with_(retry_errors=True), answering("{}")).written == 1
    got = rows(spark, job.results_path, "ordinal", "vlm_error")
    assert got == [(1, None), (2, "403 no"), (2, None)]


def test_quota_stop_is_an_exact_prefix(spark, posts, tmp_path):
    from glossa.operators.media import dispatch_url

    routed = dispatch_url(posts).filter("save_name is not null")
    every = routed.select("save_name", F.concat("save_name", F.lit(".mp4")).alias("fname"), F.lit(9).alias("size"))
    job = JOB.with_(stop_on_primary_daily_quota=True, results_path=str(tmp_path / "r"), commit_rows=15)
    stop = 17
    report = run_job(posts, job, stub_client(daily_after=stop), every)
    full = JOB.with_(results_path=str(tmp_path / "full"))
    run_job(posts, full, stub_client(), every)
    queue = sorted(
        ((r.platform is None, r.platform or "", r.ordinal) for r in read_results(spark, full.results_path).collect())
    )
    got = read_results(spark, job.results_path)
    order = [(r.platform is None, r.platform or "", r.ordinal) for r in got.collect()]
    assert report.stopped and sorted(order) == queue[: report.written] and report.stopped_at == report.written - 1
    # The first called row at or after the stop is the last one written, with its error.
    assert got.filter("vlm_error like '%GenerateRequestsPerDay%'").count() == 1
    assert stop < report.written < report.queued


@pytest.mark.parametrize(
    ("error", "calls", "written"),
    [
        ("429 quota exceeded: PerDay retry in 14h0m1s", 6, 6),
        ("429 quota per day", 6, 6),
        # Worth a retry as well, so not final at first: nothing behind it may be skipped.
        ("429 per-day retry in 5s", 20 + 15 + 15, 6),
        # No daily error at all.
        ("403 no", 20, 20),
    ],
)
def test_calls_behind_a_daily_stop_are_saved(spark, tmp_path, error, calls, written):
    from glossa.functions.text import media_save_name

    posts = spark.range(20).select(
        F.col("id").alias("ordinal"), F.format_string("https://p/%02d", "id").alias("post_url"), F.lit("x").alias("platform")
    )
    name = media_save_name(F.col("post_url"), "post")
    manifest = posts.select(name.alias("save_name"), F.concat(name, F.lit(".mp4")).alias("fname"), F.lit(1).alias("size"))
    counter = tmp_path / "calls"

    def call(request):
        with open(counter, "a") as out:
            out.write("x")
        if request["call_url"] >= "https://p/05":
            raise RuntimeError(error)
        return "{}"

    job = JOB.with_(score_partitions=1, stop_on_primary_daily_quota=True, results_path=str(tmp_path / "r"))
    report = run_job(posts, job, per_row_client(call), manifest)
    assert report.written == written and len(counter.read_text()) == calls
    assert sorted(r[0] for r in rows(spark, job.results_path, "ordinal")) == list(range(written))


def test_url_only_rows_never_stop_a_run(spark, posts, tmp_path):
    job = JOB.with_(stop_on_primary_daily_quota=True, results_path=str(tmp_path / "r"))

    def quota(request):
        raise RuntimeError("429 quota per day")

    report = run_job(posts, job, per_row_client(quota))
    assert report.written == report.queued and not report.stopped


def test_missing_post_file_never_tries_the_media_url(spark, tmp_path):
    posts = spark.createDataFrame([(1, "https://p", "https://m", "x")],
                                  "ordinal long, post_url string, media_url string, platform string")
    from glossa.functions.text import media_save_name

    name = spark.range(1).select(media_save_name(F.lit("https://m"), "media")).first()[0]
    manifest = spark.createDataFrame([(name, f"{name}.mp4", 5)], "save_name string, fname string, size long")
    job = JOB.with_(results_path=str(tmp_path / "r"))
    run_job(posts, job, answering("{}"), manifest)
    assert rows(spark, job.results_path, "vlm_url_used", "vlm_model_used") == [("url", "fallback")]


def test_attempts_and_fallback(spark, tmp_path):
    """Calls per request as the log has them: retry, back-off, fallback."""
    from glossa.plans.scoring import outcomes, score

    def call(request):
        kind, attempt = request["call_url"], request["attempt"]
        if kind == "flaky" and attempt < 2:
            raise RuntimeError("500 INTERNAL")
        if kind == "minute":
            raise RuntimeError("429 retry in 2s")
        if kind == "spent" and request["model"] == "primary":
            raise RuntimeError("429 too many")
        if kind == "daily":
            raise RuntimeError("429 quota per day")
        return {"mood": kind}

    kinds = ["flaky", "minute", "spent", "daily", "fine"]
    df = spark.createDataFrame(list(enumerate(kinds)), "k long, call_url string").withColumns(
        {"model": F.lit("primary"), KEY: F.col("call_url")})

    def build(spread):
        return spread.withColumns({"pass": F.lit(1), "prompt": F.lit("p"), "prompt_hash": F.lit("h"), "media_path": F.lit("f"),
                                   "mime": F.lit("m"), "response_schema": F.lit("{}")})

    client = per_row_client(call, keep_waits=False)
    scored = score(df, build, client, RetryPolicy(), "primary", "fallback", 3, str(tmp_path / "log"))
    log = scored.log
    assert scored.calls == 13
    # The same rows again, from the log alone.
    known = reusable(read_attempts(spark, str(tmp_path / "log")), df)
    again = score(df, build, client, RetryPolicy(), "primary", "fallback", 3, str(tmp_path / "log"), known)
    assert again.calls == 1  # the daily quota error, which may be over
    assert {(x.k, x.model_used, x.err) for x in outcomes(again.log).collect()} == {(x.k, x.model_used, x.err) for x in outcomes(log).collect()}
    calls = {r.k: r.n for r in log.groupBy("k").agg(F.count("*").alias("n")).collect()}
    # The per-minute key uses up the primary model, then the fallback.
    assert calls == {0: 3, 1: 6, 2: 2, 3: 1, 4: 1}
    got = {r.k: (r.model_used, r.err) for r in outcomes(log).collect()}
    assert got == {
        0: ("primary", None), 1: ("fallback", "429 retry in 2s"), 2: ("fallback", None),
        3: ("primary", "429 quota per day"), 4: ("primary", None),
    }
    # The same from the log alone, and the waits between attempts.
    decided = attempts.decide(log, RetryPolicy(), "primary", "fallback")
    assert {r.k: (r.model_used, r.err) for r in decided.collect()} == got
    waits = attempts.planned_wait(log.filter("model = 'primary'"), RetryPolicy(), ["k"])
    assert {r.k: r.wait_sec for r in waits.collect()} == {0: 6.0, 1: 21.0, 2: 0.0, 3: 0.0, 4: 0.0}


def test_cut_log_takes_the_last_attempt(spark):
    df = spark.createDataFrame([(1, 0, None, "500 a"), (1, 1, None, "500 b")], "k long, attempt int, resp string, err string")
    r = attempts.resolve_attempts(df, RetryPolicy(), ["k"]).first()
    assert (r.attempt, r.err) == (1, "500 b")


def test_repeated_log_rows_change_nothing(spark, sf_dir):
    log = attempts.with_reply_error(view(spark, sf_dir, "calls"))
    once = attempts.decide(log, RetryPolicy(), "primary", "fallback")
    twice = attempts.decide(log.union(log), RetryPolicy(), "primary", "fallback")
    assert once.exceptAll(twice).count() == twice.exceptAll(once).count() == 0
    waits = attempts.planned_wait(log, RetryPolicy(), ["k", "model"])
    assert waits.exceptAll(attempts.planned_wait(log.union(log), RetryPolicy(), ["k", "model"])).count() == 0


def annotating(tmp_path, **changes):
    return JOB.with_(
        results_path=str(tmp_path / "r"), annotations_path=str(tmp_path / "a"), mirror_path=str(tmp_path / "m.csv"),
        annotation=Note, annotation_template=TEMPLATE, annotation_rules={"mood": "festive"}, **changes,
    )


def replying(request):
    if request["pass"] == 1:
        return {"mood": "FESTIVE" if "1" in request["call_url"] else "calm"}
    if "2" in request["call_url"]:
        raise RuntimeError("403 second")
    assert '"prior_analysis":{"caption":null,"score":null,"mood":"FESTIVE"' in request["prompt"] and '"platform":' in request["prompt"]
    return {"caption": "because", "indoors": True}


def test_second_pass(spark, posts, manifest, tmp_path):
    job = annotating(tmp_path).with_(attempts_path=str(tmp_path / "log"))
    report = run_job(posts, job, per_row_client(replying), manifest)
    got = read_results(spark, job.results_path)
    log = read_attempts(spark, job.log_path)
    assert {r["pass"] for r in log.collect()} == {1, 2}
    assert log.join(got, KEY, "left_anti").count() == 0
    high = got.filter("vlm_mood = 'FESTIVE'").collect()
    assert high and all(r.vlm_annotation_model_used for r in high)
    for r in high:
        url = (r.post_url or "").strip() if (r.post_url or "NaN") != "NaN" else r.media_url
        if "2" in url:
            assert (r.vlm_annotation_json, r.vlm_annotation_error) == (None, "403 second")
        else:
            assert r.vlm_annotation_json == '{"caption":"because","lang":"und","indoors":true}'
    rest = got.filter("coalesce(vlm_mood, '') <> 'FESTIVE'")
    assert rest.filter("vlm_annotation_json is not null or vlm_annotation_model_used is not null").count() == 0
    assert read_results(spark, job.annotations_path).count() == len(high)
    assert read_results(spark, job.annotations_path).columns[0] == KEY
    mirror = read_results(spark, job.mirror_path)
    assert mirror.count() == report.written and set(mirror.columns) == set(got.columns)
    own = [c for c in got.columns if c.startswith("vlm_")]
    assert own == sorted(own) and got.columns[:2] == ["ordinal", "post_url"]


def test_row_hook_and_its_failures(spark, posts, tmp_path):
    schema = T.StructType.fromDDL("vlm_note_json string, vlm_note_error string, vlm_note_model_used string, vlm_len long")

    def note(reply, row, analysis, key, media):
        if row["platform"] == "x":
            raise ValueError("no x")
        return {"vlm_note_json": analysis["mood"], "vlm_len": len(key), "vlm_note_model_used": "ignored"}

    job = annotating(tmp_path, annotation_columns=row_hook(note, schema)).with_(annotations_path="", mirror_path="")
    run_job(posts, job, per_row_client(lambda r: {"mood": "FESTIVE"} if r["pass"] == 1 else "{}"))
    got = read_results(spark, job.results_path).filter("vlm_mood is not null")
    assert got.filter("vlm_note_model_used <> 'fallback' or vlm_note_model_used is null").count() == 0
    bad = got.filter("platform = 'x'")
    assert {(r.vlm_note_json, r.vlm_note_error, r.vlm_len) for r in bad.collect()} == {
        (None, "Annotation materialise error: no x", None)}
    good = got.filter("coalesce(platform, '') <> 'x'")
    assert {(r.vlm_note_json, r.vlm_note_error, r.vlm_len) for r in good.collect()} == {("FESTIVE", None, 64)}


def test_criteria_prompt_and_own_rows(spark, posts, tmp_path):
    job = annotating(tmp_path).with_(
        annotation_rules=None, annotation_template=None, mirror_path="",
        annotation_criteria=lambda a: a["score"] > 1,
        annotation_prompt=lambda key, analysis, row: F.concat(F.lit("look at "), key),
        annotation_rows=lambda df: df.select(F.col(KEY).alias("id")),
    )

    def call(request):
        if request["pass"] == 1:
            return {"score": 2 if "1" in request["call_url"] else 0}
        assert request["prompt"].startswith("look at ")
        return "{}"

    run_job(posts, job, per_row_client(call))
    got = read_results(spark, job.results_path)
    assert read_results(spark, job.annotations_path).columns == ["id"]
    assert read_results(spark, job.annotations_path).count() == got.filter("vlm_score = 2").count() > 0


@dataclass
class Typed:
    word: str
    n: int


def test_typed_replies_are_taken(spark, tmp_path):
    posts = spark.createDataFrame([(1, "u", "x")], "ordinal long, post_url string, platform string")
    job = JOB.with_(analysis=Typed, results_path=str(tmp_path / "r"))
    run_job(posts, job, per_row_client(lambda request: {"word": "w", "n": 3}))
    assert rows(spark, job.results_path, "vlm_word", "vlm_n") == [("w", 3)]


def test_project_file(spark, tmp_path):
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts/p.txt").write_text("Look.", encoding="utf-8")
    (tmp_path / "schemas.py").write_text(
        "from __future__ import annotations\nfrom dataclasses import dataclass\nfrom enum import Enum\n"
        "class L(str, Enum):\n    A = 'A'\n    B = 'B'\n@dataclass\nclass Mine:\n    level: L\n    why: str | None\n")
    (tmp_path / "hooks.py").write_text("def annotation_criteria(a):\n    return a['level'] == 'A'\n")
    (tmp_path / "project.toml").write_text(
        "[schemas]\nanalysis_class = 'Mine'\n[prompts]\nfirst_pass = 'prompts/p.txt'\n[hooks]\nmodule = 'hooks.py'\n"
        "[paths]\ninput_csv = 'in.csv'\nlocal_results_csv = 'out.csv'\n[models]\nprimary = 'P'\nfallback = 'F'\n"
        "[retry]\nmax_attempts = 2\n[processing]\nrows_per_platform = 1\nsort_columns = ['platform']\n"
        "[dedup]\nkey_columns = ['post_url']\n")
    (tmp_path / "in.csv").write_text(
        'post_url,platform,note\n"https://a",x,"say ""hi"",\nthere"\nhttps://b,x,NA\nhttps://c,y,\nhttps://a,y,dup\n')
    job = load_job(tmp_path / "project.toml").with_(score_partitions=2)
    assert (job.primary_model, job.retry.max_attempts, job.key_columns) == ("P", 2, ("post_url",))
    assert job.annotation_criteria is not None and job.annotation is None
    report = run_project(spark, job, answering('{"level":"b"}'))
    assert report.written == 2
    assert rows(spark, job.results_path, "post_url", "note", "vlm_level", "vlm_model_used") == [
        ("https://a", 'say "hi",\nthere', "B", "F"), ("https://c", None, "B", "F")]
    assert run_project(spark, job, answering('{"level":"b"}')).written == 1
    assert processed_keys(spark, job.results_path).count() == 3
    assert "ordinal" not in read_results(spark, job.results_path).columns


def test_media_folder_lookup_and_listing(spark, tmp_path):
    from glossa.functions.text import media_save_name
    from glossa.operators.media import resolve_media
    from glossa.sources.media import list_media, media_manifest

    urls = ["https://a", "https://b", "https://c"]
    names = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string")
             .select(media_save_name(F.col("u"), "post")).collect()]
    store = tmp_path / "media"
    files = {f"{names[0]}/{names[0]}.mp4": "", f"{names[0]}/{names[0]}_2.jpg": "x", f"{names[0]}/other.jpg": "x",
             f"{names[1]}/{names[1]}.webp": "x", f"{names[1]}/{names[1]}.mp4": "x", "else/else.mp4": "x"}
    for name, content in files.items():
        (store / name).parent.mkdir(parents=True, exist_ok=True)
        (store / name).write_text(content)
    want = {(names[0], f"{names[0]}_2.jpg"), (names[1], f"{names[1]}.mp4")}
    asked = list_media(spark.createDataFrame([(n,) for n in names], "save_name string"), str(store))
    found = {tuple(r) for r in resolve_media(asked).collect()}
    assert found == {(name, file, f"{store}/{name}/{file}") for name, file in want}
    every = resolve_media(media_manifest(spark, str(store)))
    assert {tuple(r)[:2] for r in every.collect()} == want | {("else", "else.mp4")}
    with pytest.raises(FileNotFoundError):
        list_media(spark.createDataFrame([("n",)], "save_name string"), str(tmp_path / "absent"))
    with pytest.raises(FileNotFoundError):
        media_manifest(spark, str(tmp_path / "none"))

    posts = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "ordinal long, post_url string, platform string")
    job = JOB.with_(results_path=str(tmp_path / "r"), media_dir=str(store))
    seen = per_row_client(lambda request: {"caption": request["media_path"]})
    run_job(posts, job, seen)
    assert rows(spark, job.results_path, "ordinal", "vlm_url_used", "vlm_caption") == [
        (0, "post", f"{store}/{names[0]}/{names[0]}_2.jpg"), (1, "post", f"{store}/{names[1]}/{names[1]}.mp4"), (2, "url", None)]
    # A manifest table with its own paths is preferred.
    kept = spark.createDataFrame([(names[2], f"{names[2]}.mp4", 5, "s3a://far/away.mp4")], "save_name string, fname string, size long, path string")
    kept.write.parquet(str(tmp_path / "manifest"))
    job = JOB.with_(results_path=str(tmp_path / "r2"), media_dir=str(store), media_manifest=str(tmp_path / "manifest"))
    run_job(posts, job, seen)
    assert rows(spark, job.results_path, "ordinal", "vlm_caption") == [(0, None), (1, None), (2, "s3a://far/away.mp4")]


@pytest.mark.parametrize(("given", "want"), [
    ("s3a://bucket/results", "s3a://bucket/results"), ("hdfs://nn/results.csv", "hdfs://nn/results.csv"),
    ("file:///mnt/shared", "file:///mnt/shared"), ("/abs/results", "/abs/results"), ("rel/results", "HOME/rel/results"), ("", ""),
])
def test_paths_of_a_project_file(tmp_path, given, want):
    (tmp_path / "p.txt").write_text("Look.", encoding="utf-8")
    (tmp_path / "schemas.py").write_text("from dataclasses import dataclass\n@dataclass\nclass Mine:\n    why: str\n")
    names = ("local_results_csv", "annotations", "attempts", "mirror_csv", "media_downloads", "media_manifest", "input_csv")
    paths = "".join(f"{n} = '{given}'\n" for n in names)
    (tmp_path / "project.toml").write_text(
        f"[schemas]\nanalysis_class = 'Mine'\n[prompts]\nfirst_pass = 'p.txt'\n[processing]\nmultiline_csv = false\n[paths]\n{paths}")
    job = load_job(tmp_path / "project.toml")
    want = want.replace("HOME", str(tmp_path.resolve()))
    assert [job.results_path, job.annotations_path, job.attempts_path, job.mirror_path, job.media_dir, job.media_manifest, job.input_path] == [want] * 7
    assert job.log_path == (want or "-attempts") and not job.multiline_csv


def test_local_paths_are_refused_on_a_cluster(spark):
    from types import SimpleNamespace

    from glossa.session import shared_path

    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077"))
    assert shared_path(cluster, "s3a://b/x") and shared_path(cluster, "file:///mnt/x") and shared_path(spark, "/tmp/x")
    with pytest.raises(ValueError):
        shared_path(cluster, "/tmp/x")


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    from glossa.sources.posts import read_csv

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.csv").write_text("post_url,platform\nhttps://a,x\n")
    (tmp_path / "in/b.csv").write_text("platform,post_url\ny,https://b\n")
    for multiline in (True, False):
        with pytest.raises(Exception, match="header does not conform"):
            read_csv(spark, str(tmp_path / "in"), multiline=multiline).collect()


def test_a_retry_waits_and_cores_do_not_decide_the_tasks(spark, tmp_path):
    import time

    posts = spark.range(6).select(F.col("id").alias("ordinal"), F.format_string("https://p/%d", "id").alias("post_url"), F.lit("x").alias("platform"))
    started = time.time()

    def call(request):
        if time.time() < started + 1.0 or request["attempt"] == 0:
            raise RuntimeError("429 retry in 2s")
        with open(tmp_path / f"task-{__import__('os').getpid()}-{__import__('pyspark').TaskContext.get().partitionId()}", "a"):
            pass
        return "{}"

    job = JOB.with_(
        results_path=str(tmp_path / "r"), score_partitions=0, rows_per_task=2, retry=RetryPolicy(max_attempts=2, rate_limit_margin_sec=1.0))
    report = run_job(posts, job, per_row_client(call, threads=2))
    assert report.calls == 12 and time.time() - started >= 3
    log = read_attempts(spark, job.log_path)
    ends = {(x.k, x.attempt): x.ended_at for x in log.collect()}
    assert all(ends[(k, 1)] - ends[(k, 0)] >= 3 for k in range(6))
    assert rows(spark, job.results_path, "vlm_error") == [(None,)] * 6
    from glossa.plans.run import run_queue  # noqa: F401

    assert len({p.name.split("-")[-1] for p in tmp_path.glob("task-*")}) > 1


def test_requests_carry_the_schema_of_the_reply(spark, tmp_path):
    import json

    from glossa.schema_spec import response_schema
    from suite.schemas import Scene

    posts = spark.createDataFrame([(1, "u", "x")], "ordinal long, post_url string, platform string")
    job = JOB.with_(results_path=str(tmp_path / "r"))
    run_job(posts, job, per_row_client(lambda request: {"caption": request["response_schema"]}))
    got = json.loads(rows(spark, job.results_path, "vlm_caption")[0][0])
    assert got == json.loads(response_schema(Scene))
    assert got["properties"]["caption"] == {"type": "string", "description": "One sentence on what is to be seen.", "nullable": True}
    assert got["properties"]["mood"] == {"type": "string", "enum": ["FESTIVE", "LIVELY", "CALM", "GRIM"]}
    assert got["properties"]["objects"] == {"type": "array", "items": {"type": "string"}}
    assert got["properties"]["spot"]["properties"]["city"] == {"type": "string", "nullable": True}
    assert got["required"] == ["caption", "score"]


def test_empty_results_have_every_column(spark, tmp_path):
    from glossa.operators.results import empty_results, result_columns
    from glossa.schema_spec import schema_spec

    spec = schema_spec(Typed)
    source = T.StructType.fromDDL("ordinal long, vlm_content_key string")
    empty = empty_results(spark, source, spec, ["vlm_annotation_json"])
    assert empty.count() == 0
    assert set(empty.columns) == {"ordinal", *result_columns(spec, ["vlm_annotation_json"])}
    assert dict(empty.dtypes)["vlm_n"] == "bigint"


def test_csv_files_have_the_wanted_rows(spark, posts, tmp_path):
    job = JOB.with_(results_path=str(tmp_path / "r.csv"), append_chunk_size=5, score_partitions=1)
    report = run_job(posts, job, answering("{}"))
    sizes = [p.read_text().count("\n") - 1 for p in (tmp_path / "r.csv").rglob("*.csv") if p.is_file()]
    assert sum(sizes) == report.written and max(sizes) <= 5


def test_scratch_is_gone_after_a_run(spark, posts, tmp_path):
    from pathlib import Path

    from glossa.session import scratch_root

    left = set(Path(scratch_root(spark)).iterdir())
    run_job(posts, JOB.with_(results_path=str(tmp_path / "r")), answering("{}"))
    assert set(Path(scratch_root(spark)).iterdir()) == left


def test_stream_delivers_each_key_once(spark, posts, tmp_path):
    source = str(tmp_path / "in")
    half = posts.filter("ordinal % 2 = 0").coalesce(1)
    half.write.mode("append").parquet(source)
    arriving = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    job = JOB.with_(results_path=str(tmp_path / "r"))

    def drain(checkpoint):
        annotate_stream(arriving, job, stub_client(), str(tmp_path / checkpoint)).awaitTermination()
        return read_results(spark, job.results_path).count()

    first = drain("c1")
    assert first > 0
    posts.filter("ordinal % 2 = 1").coalesce(1).write.mode("append").parquet(source)
    both = drain("c1")
    assert both > first
    assert drain("c2") == both


def test_commit_ledger_steps_and_a_clean_start_reads_no_results(spark, posts, manifest, tmp_path, monkeypatch):
    steps = []
    job = annotating(tmp_path, commit_progress=lambda chunk, step, rows: steps.append((step, rows)))
    run_job(posts, job, per_row_client(replying), manifest)
    assert [s for s, _ in steps] == ["staged", "results", "annotations", "mirror", "closed"]
    assert len({n for _, n in steps}) == 1
    from glossa.plans import run as plan
    from glossa.sinks.ledger import Ledger

    ledger = Ledger(job.ledger_path)
    assert ledger.open_chunks(spark) == [] and ledger.entries(spark).count() == 1

    def refuse(*_):
        raise AssertionError("a clean start read a table")

    monkeypatch.setattr(plan, "read_results", refuse)
    assert plan.repair_copies(spark, job) == []


def test_a_chunk_staged_in_part_is_dropped_and_one_lost_after_results_is_completed(spark, posts, manifest, tmp_path):
    from glossa.plans.run import repair_copies
    from glossa.sinks.ledger import Ledger

    def lose(chunk, step, rows):
        if step == "results":
            raise ConnectionError("gone")

    job = annotating(tmp_path)
    with pytest.raises(ConnectionError):
        run_job(posts, job.with_(commit_progress=lose), per_row_client(replying), manifest)
    ledger = Ledger(job.ledger_path)
    (open_chunk,) = ledger.open_chunks(spark)
    assert ledger.marks(spark, open_chunk) == {"results"}
    assert read_results(spark, job.mirror_path) is None
    # A staged folder without its success file: no table got it.
    spark.range(3).write.parquet(f"{ledger.root}/staged/chunk-0-partial/rows")
    fs = spark._jvm.org.apache.hadoop.fs.Path(f"{ledger.root}/staged/chunk-0-partial/rows/_SUCCESS")
    fs.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(fs, False)
    assert repair_copies(spark, job) == [open_chunk]
    assert ledger.open_chunks(spark) == []
    results, mirror = read_results(spark, job.results_path), read_results(spark, job.mirror_path)
    assert results.count() == mirror.count() == mirror.select(KEY).distinct().count()
    festive = results.filter("vlm_mood = 'FESTIVE'").count()
    assert read_results(spark, job.annotations_path).count() == festive


def test_stream_state_later_batches_read_neither_results_nor_log(spark, posts, manifest, tmp_path, monkeypatch):
    from glossa.plans import run as plan

    reads = []
    for name in ("processed_keys", "read_attempts"):
        real = getattr(plan, name)
        monkeypatch.setattr(plan, name, lambda *a, _real=real, _name=name, **k: reads.append(_name) or _real(*a, **k))
    from glossa.operators.queue import with_content_key

    source = str(tmp_path / "in")
    posts.filter("ordinal % 3 = 0").coalesce(1).write.parquet(source)
    arriving = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    posts.filter("ordinal % 3 = 1").coalesce(1).write.mode("append").parquet(source)
    posts.coalesce(1).write.mode("append").parquet(source)  # late repeats of every key
    job = JOB.with_(results_path=str(tmp_path / "r"))
    annotate_stream(arriving, job, stub_client(), str(tmp_path / "ck"), manifest, state=True).awaitTermination()
    # The state starts from the results once; only the first batch of the start checks the results and the log.
    assert reads.count("processed_keys") == 1 and reads.count("read_attempts") <= 1
    got = read_results(spark, job.results_path)
    keys = with_content_key(posts, JOB.key_columns).select(KEY).distinct().count()
    # Every key once at most, though each arrived twice or three times; rows that a run drops (first per raw URL) stay out.
    assert 0 < got.count() == got.select(KEY).distinct().count() <= keys


def test_scratch_paths_work_where_the_checkpoint_folder_has_no_scheme(spark, monkeypatch):
    from glossa.session import scratch_path, scratch_root, shared_path
    from suite.queries import QUERIES

    plain = scratch_root(spark)
    assert "://" not in plain and not plain.startswith("file:")
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    assert scratch_root(spark) == f"file:{plain}"
    assert shared_path(spark, scratch_path(spark, "any") + "/table")
    assert QUERIES["media_lookup"](spark, "/root/testdata/sf0.001").count() == 50


def test_what_tasks_run_does_not_need_the_package():
    """Loaded in a process that finds neither ``glossa`` nor ``suite``."""
    import subprocess

    from glossa.streaming.incremental import FirstOfKey
    from suite.queries import two_pass_client

    code = "import pickle, sys; x = pickle.loads(sys.stdin.buffer.read()); x[0](); x[1]('ordinal')"
    sent = cloudpickle.dumps((two_pass_client(), FirstOfKey))
    done = subprocess.run([sys.executable, "-c", code], input=sent, capture_output=True, cwd="/tmp", env={"PATH": ""})
    assert done.returncode == 0, done.stderr.decode()
