"""Job settings, one frozen object per job."""

from __future__ import annotations

import importlib.util
import sys
import tomllib
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from pyspark import cloudpickle

# Defaults of a job.
DEFAULT_PRIMARY_MODEL = "gemini-3.1-pro-preview"
DEFAULT_FALLBACK_MODEL = "gemini-3-flash-preview"
DEFAULT_MAX_ATTEMPTS = 3
DEFAULT_BASE_DELAY_SEC = 2
DEFAULT_RATE_LIMIT_MARGIN_SEC = 5
DEFAULT_KEY_COLUMNS = ("post_url", "media_url", "platform")


@dataclass(frozen=True)
class RetryPolicy:
    max_attempts: int = DEFAULT_MAX_ATTEMPTS
    base_delay_sec: float = DEFAULT_BASE_DELAY_SEC
    rate_limit_margin_sec: float = DEFAULT_RATE_LIMIT_MARGIN_SEC


@dataclass(frozen=True)
class JobConfig:
    """What a job computes. ``analysis`` and ``annotation`` are dataclasses (see ``schema_spec``)."""

    analysis: type
    prompt: str

    primary_model: str = DEFAULT_PRIMARY_MODEL
    fallback_model: str = DEFAULT_FALLBACK_MODEL
    retry: RetryPolicy = field(default_factory=RetryPolicy)

    rows_per_platform: int = 0
    stop_on_primary_daily_quota: bool = True
    shuffle_batch: bool = False
    shuffle_seed: str = "0"
    required_input_columns: tuple[str, ...] = ("platform",)
    sort_columns: tuple[str, ...] = ("platform",)
    sort_ascending: tuple[bool, ...] = (True,)
    key_columns: tuple[str, ...] = DEFAULT_KEY_COLUMNS
    ordinal: str = "ordinal"
    keep_null_urls: bool = False
    retry_errors: bool = False

    # Rows whose results are appended together. Calls are kept as they are made (``log_path``), so
    # this does not decide what a crash costs.
    commit_rows: int = 100_000
    # Quota probing in waves: chunks of this many rows, doubling up to ``commit_rows``; a wave starts only
    # when the one before met no daily quota error, so calls behind a stop are those of one wave at most (0: off).
    first_wave_rows: int = 0
    # Most rows of a file of the CSV tables (0 = as many as a task has).
    append_chunk_size: int = 0
    # Rows a task calls the model for; replies are kept when a task ends.
    rows_per_task: int = 200
    # Tasks per round, whatever the rows (0 = by ``rows_per_task``).
    score_partitions: int = 0
    # The call log is merged after each chunk into one file per key bucket; merged files below
    # ``log_small_file_bytes`` are merged again. A run reads only the buckets of its queue.
    log_buckets: int = 64
    log_small_file_bytes: int = 64 << 20
    # One request rate for the whole cluster (``operators.rate``): first calls of a model start no more than
    # these many a minute (``default_requests_per_minute`` for others), ``burst_requests`` more in the first minute.
    requests_per_minute: dict[str, int] | None = None
    default_requests_per_minute: int = 60
    burst_requests: int = 0
    # Called on the driver as (chunk, step, rows) after each step of a commit: staged, results,
    # annotations, mirror, closed. It may report progress; what it raises stops the run there.
    commit_progress: Callable | None = None
    # Whether cells of CSV input may hold line breaks; then each file is one task.
    multiline_csv: bool = True

    annotation: type | None = None
    annotation_template: str | None = None
    annotation_rules: dict[str, Any] | None = None
    annotation_criteria: Callable | None = None
    annotation_prompt: Callable | None = None
    annotation_columns: Callable | None = None
    annotation_headers: tuple[str, ...] | None = None
    annotation_rows: Callable | None = None

    input_path: str = ""
    results_path: str = ""
    mirror_path: str = ""
    annotations_path: str = ""
    # Where every attempt of every call is kept; beside the results if empty.
    attempts_path: str = ""
    media_dir: str = ""
    # A table of the store's files (save_name, fname, size, path); preferred to listing the folder.
    media_manifest: str = ""

    @property
    def log_path(self) -> str:
        return self.attempts_path or f"{self.results_path.rstrip('/')}-attempts"

    @property
    def ledger_path(self) -> str:
        """The commit ledger of the results and their copies (``sinks.ledger``), beside the results."""
        return f"{self.results_path.rstrip('/')}-ledger"

    def with_(self, **changes: Any) -> JobConfig:
        return replace(self, **changes)


def _load_module(path: Path, name: str):
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    sys.modules[name] = module
    spec.loader.exec_module(module)
    # Executors cannot import it by name.
    cloudpickle.register_pickle_by_value(module)
    return module


def load_job(toml_path: str | Path) -> JobConfig:
    """Read a project file: paths are relative to it, schemas and hooks are Python files beside it.

    Hooks are Spark-side (Columns in, Columns out; see README); a hooks file may define
    ``annotation_criteria``, ``annotation_columns``, ``annotation_prompt``,
    ``annotation_headers`` and ``annotation_rows``.
    """
    toml_path = Path(toml_path).resolve()
    home = toml_path.parent
    raw = tomllib.loads(toml_path.read_text(encoding="utf-8"))

    def part(name: str) -> dict[str, Any]:
        return raw.get(name, {})

    def resolved(key: str, default: str = "") -> str:
        value = part("paths").get(key, default)
        # A URI stays as it is; other paths are relative to the project file.
        if not value or "://" in value or value.startswith("file:"):
            return value
        return str((home / value).resolve())

    schemas = _load_module(home / part("schemas").get("module", "schemas.py"), f"schemas_{home.name}")
    annotation = part("schemas").get("annotation_class")
    template = part("prompts").get("annotation_template")

    found: dict[str, Any] = {}
    if part("hooks").get("module"):
        hooks = _load_module(home / part("hooks")["module"], f"hooks_{home.name}")
        for name in ("annotation_criteria", "annotation_columns", "annotation_prompt",
                     "annotation_headers", "annotation_rows"):
            if hasattr(hooks, name):
                found[name] = getattr(hooks, name)

    direct = {
        name: part("processing")[name]
        for name in ("rows_per_platform", "stop_on_primary_daily_quota", "shuffle_batch", "multiline_csv", "rows_per_task")
        if name in part("processing")
    }
    lists = {
        name: tuple(part("processing")[name])
        for name in ("required_input_columns", "sort_columns", "sort_ascending")
        if name in part("processing")
    }
    retry = {
        name: part("retry")[name]
        for name in ("max_attempts", "base_delay_sec", "rate_limit_margin_sec")
        if name in part("retry")
    }
    return JobConfig(
        analysis=getattr(schemas, part("schemas")["analysis_class"]),
        prompt=(home / part("prompts")["first_pass"]).read_text(encoding="utf-8"),
        primary_model=part("models").get("primary", DEFAULT_PRIMARY_MODEL),
        fallback_model=part("models").get("fallback", DEFAULT_FALLBACK_MODEL),
        retry=RetryPolicy(**retry),
        key_columns=tuple(part("dedup").get("key_columns", DEFAULT_KEY_COLUMNS)),
        append_chunk_size=part("sheets").get("append_chunk_size", 0),
        annotation=getattr(schemas, annotation) if annotation else None,
        annotation_template=(home / template).read_text(encoding="utf-8") if template else None,
        annotation_rules=part("annotation").get("field_rules"),
        input_path=resolved("input_csv", "data/input.csv"),
        results_path=resolved("local_results_csv", "data/results.csv"),
        mirror_path=resolved("mirror_csv"),
        annotations_path=resolved("annotations"),
        attempts_path=resolved("attempts"),
        media_manifest=resolved("media_manifest"),
        # A store that is named must exist; the usual folder beside the project file may be absent.
        media_dir=resolved("media_downloads", "media_downloads" if (home / "media_downloads").is_dir() else ""),
        **direct,
        **lists,
        **found,
    )
