"""From posts to the queue of rows to score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from glossa.config import JobConfig
from glossa.functions.text import download_error, mime_type
from glossa.operators.media import dispatch_url, join_by_name, resolve_media, with_route
from glossa.operators.positions import OrderedTable, order_table
from glossa.operators.queue import (
    KEY,
    dedup_first,
    first_rows,
    pending,
    require_columns,
    shuffle_order,
    sort_order,
    top_per_group,
    with_content_key,
)
from glossa.session import write_scratch
from glossa.sources.media import list_media


@dataclass(frozen=True)
class Queue:
    """The ordered batch on disk, and the input columns its results carry."""

    ordered: OrderedTable
    source_columns: list[str]

    @property
    def count(self) -> int:
        return self.ordered.count


def pending_posts(posts: DataFrame, processed: DataFrame, job: JobConfig) -> DataFrame:
    """Deduplicated posts with their key, minus those already processed."""
    unique = dedup_first(posts, "post_url", job.ordinal, job.keep_null_urls)
    keyed = with_content_key(require_columns(unique, job.required_input_columns), job.key_columns)
    return pending(keyed, processed)


def capped(rows: DataFrame, job: JobConfig) -> DataFrame:
    """The cap per group: by the first sort column, despite the setting's name."""
    if job.rows_per_platform <= 0:
        return rows
    order = sort_order(rows, job.sort_columns, job.sort_ascending, job.ordinal)
    group = job.sort_columns[0] if job.sort_columns else "platform"
    if group in rows.columns:
        return top_per_group(rows, group, job.rows_per_platform, order)
    return first_rows(rows, job.rows_per_platform, order)


def queue_rows(posts: DataFrame, processed: DataFrame, job: JobConfig) -> DataFrame:
    return capped(pending_posts(posts, processed, job), job)


def with_media(rows: DataFrame, job: JobConfig, manifest: DataFrame | None,
               failures: DataFrame | None = None) -> DataFrame:
    """Add route, media file, media type and download error.

    Without a manifest, the job's manifest table is read, or its media folder asked for the
    names in ``rows``. ``media_path`` is where the file is: the manifest's path, else its place
    in the media folder.
    ``failures`` (``save_name``, ``video_error``, ``image_error``) is what a downloader
    recorded for files that are not in the store.
    """
    routed = dispatch_url(rows)
    if manifest is None and job.media_manifest:
        manifest = rows.sparkSession.read.parquet(job.media_manifest)
    if manifest is None and job.media_dir:
        # Both the listing and the join read these rows: planned and read once.
        routed = write_scratch(routed, "routed")
        manifest = list_media(routed.filter("save_name is not null").select("save_name").distinct(), job.media_dir)
    if manifest is None:
        nothing = F.lit(None).cast("string")
        found = routed.withColumns({"media_fname": nothing, "media_path": nothing})
    else:
        found = join_by_name(routed, resolve_media(manifest), job.ordinal)
    if failures is None:
        found = found.withColumn("download_error", F.lit(None).cast("string"))
    else:
        why = failures.groupBy("save_name").agg(
            F.max(download_error(F.col("video_error"), F.col("image_error"))).alias("download_error")
        )
        found = join_by_name(found, why, job.ordinal).withColumn(
            "download_error", F.when(F.col("media_fname").isNull(), F.col("download_error"))
        )
    in_store = F.concat_ws("/", F.lit(job.media_dir.rstrip("/") or None), "save_name", "media_fname")
    path = F.when(F.col("media_fname").isNotNull(), F.coalesce("media_path", in_store))
    return with_route(found).withColumns({"media_path": path, "mime": mime_type(F.col("media_fname"))})


# Working columns of the queue that results do not carry.
ROUTE_COLUMNS = (
    "call_url", "url_role", "save_name", "media_fname", "media_path", "download_error", "url_used", "mime",
)

# Names a run needs for itself; input columns must not use them.
RESERVED_COLUMNS = (*ROUTE_COLUMNS, "analysis", "resp", "err", "model_used", "k", "model", "prompt")


def check_names(posts: DataFrame) -> DataFrame:
    taken = [c for c in posts.columns if c in RESERVED_COLUMNS or c.startswith("_")]
    if taken:
        raise ValueError(f"Rename input columns {taken}: a run uses these names.")
    return posts


def prepare(
    posts: DataFrame,
    processed: DataFrame,
    job: JobConfig,
    manifest: DataFrame | None = None,
    failures: DataFrame | None = None,
) -> Queue | None:
    """Build and write the queue; None when every row is already done."""
    rows = queue_rows(check_names(posts), processed, job)
    # A struct is the reader's own numbering (sources.posts.input_order), not a user column.
    numbered = isinstance(posts.schema[job.ordinal].dataType, StructType)
    source = [c for c in rows.columns if c != job.ordinal or not numbered]
    if job.shuffle_batch:
        order = shuffle_order(KEY, job.ordinal, job.shuffle_seed)
    else:
        order = sort_order(rows, job.sort_columns, job.sort_ascending, job.ordinal)
    ordered = order_table(with_media(rows, job, manifest, failures), order, "queue")
    return Queue(ordered, source) if ordered.count else None
