"""The log of calls, and how saved raw responses become one."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from glossa.functions.errors import is_daily
from glossa.functions.reply import reply_text
from glossa.operators.queue import KEY
from glossa.session import _file_system, path_exists

# ``prompt_hash`` tells calls of changed prompts apart; ``called`` is false for rows skipped behind a daily
# quota error; ``ended_at`` is when the call ended, in seconds of the epoch.
CALL_COLUMNS = ["pass", "model", "attempt", "prompt_hash"]
LOG_SCHEMA = (
    f"k long, {KEY} string, pass int, model string, attempt int, prompt_hash string, called boolean,"
    " ended_at double, resp string, err string"
)

# The part of a raw response that holds text; other part kinds are skipped.
RESPONSE_SCHEMA = "candidates array<struct<content: struct<parts: array<struct<text: string>>>>>"

# Files of finished tasks stay although their job, or the driver, does not finish.
_KEEP_FINISHED_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}


# Layout of a log folder: every round of calls writes ``round-<id>/`` as its tasks end; once a chunk is committed
# the rounds are merged into ``merged/bucket=<b>/``, one file per key bucket, and removed. Small merged files of a
# bucket are merged again, so a bucket holds few files however many rounds there were.
MERGED = "merged"
ROUND_PREFIX = "round-"
LOG_BUCKETS = 64
SMALL_FILE_BYTES = 64 << 20


def log_bucket(key: Column, buckets: int = LOG_BUCKETS) -> Column:
    """Bucket of a content key: its first four hex digits as a number, modulo ``buckets`` (at most 65,536).

    Keys are SHA-256 hex, so buckets are even; a key that is not hex, or empty, falls in bucket 0.
    """
    return F.coalesce(F.pmod(F.conv(F.substring(key, 1, 4), 16, 10).cast("int"), F.lit(buckets)), F.lit(0))


def _listing(spark: SparkSession, pattern: str) -> list:
    fs, where = _file_system(spark, pattern)
    found = fs.globStatus(where)
    return list(found) if found is not None else []


def round_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of rounds not merged yet."""
    return sorted(str(f.getPath().toString()) for f in _listing(spark, f"{path.rstrip('/')}/{ROUND_PREFIX}*") if f.isDirectory())


def merged_files(spark: SparkSession, path: str) -> list[tuple[int, str, int]]:
    """(bucket, file, bytes) of every merged data file."""
    out = []
    for f in _listing(spark, f"{path.rstrip('/')}/{MERGED}/bucket=*/*.parquet"):
        name = f.getPath()
        out.append((int(name.getParent().getName().split("=", 1)[1]), str(name.toString()), int(f.getLen())))
    return sorted(out)


def read_attempts(spark: SparkSession, path: str, keys: DataFrame | None = None, buckets: int = LOG_BUCKETS) -> DataFrame | None:
    """Calls kept under ``path``, merged or not; None if there are none.

    With ``keys`` (a column ``KEY``) only the buckets of those keys are opened: the merged table is read with
    a filter on its bucket folders, so the other folders are never listed or read. The buckets are found
    by one aggregation (at most ``buckets`` values reach the driver).
    """
    if not path_exists(spark, path):
        return None
    wanted = None
    if keys is not None:
        wanted = [r[0] for r in keys.select(log_bucket(F.col(KEY), buckets).alias("b")).distinct().collect()]
    parts = []
    rounds = round_folders(spark, path)
    if rounds:
        unmerged = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(*rounds)
        if wanted is not None:
            unmerged = unmerged.filter(log_bucket(F.col(KEY), buckets).isin(wanted))
        parts.append(unmerged)
    merged = f"{path.rstrip('/')}/{MERGED}"
    if path_exists(spark, merged):
        table = spark.read.schema(f"{LOG_SCHEMA}, bucket int").parquet(merged)
        if wanted is not None:
            table = table.filter(F.col("bucket").isin(wanted))
        parts.append(table.drop("bucket"))
    if not parts:
        return None
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@dataclass(frozen=True)
class MergeReport:
    """What a merge read (round folders, merged files) and wrote (files, rows); nothing happened if both reads are 0."""

    rounds: int
    files_read: int
    files_written: int
    rows: int


def merge_rounds(spark: SparkSession, path: str, buckets: int = LOG_BUCKETS, small_bytes: int = SMALL_FILE_BYTES) -> MergeReport:
    """Merge the log's rounds, and its merged files under ``small_bytes``, into one new file per bucket.

    Exact repeats of a row are kept once. The new files are written beside the table and moved into their bucket
    folders before the files they replace are removed, so a reader sees every row at any time; one that reads
    in between may see a row twice, which changes no answer (``reusable`` takes one per call). A merge that
    stops half way leaves repeats that the next merge removes. The driver lists file names, never rows.
    """
    path = path.rstrip("/")
    rounds = round_folders(spark, path)
    small = [(b, f) for b, f, size in merged_files(spark, path) if size < small_bytes]
    crowded = {b for b, _ in small if sum(1 for c, _ in small if c == b) > 1}
    if rounds:
        crowded |= {b for b, _ in small}
    small = [(b, f) for b, f in small if b in crowded]
    if not rounds and not small:
        return MergeReport(0, 0, 0, 0)
    parts = []
    if rounds:
        unmerged = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(*rounds)
        parts.append(unmerged.withColumn("bucket", log_bucket(F.col(KEY), buckets)))
    if small:
        parts.append(
            spark.read.schema(f"{LOG_SCHEMA}, bucket int").option("basePath", f"{path}/{MERGED}").parquet(*[f for _, f in small])
        )
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    staging = f"{path}/{MERGED}/_staging-{uuid.uuid4().hex}"
    seen = Observation()
    # Each bucket goes to one task, which writes it as one file.
    (rows.distinct().repartition("bucket").sortWithinPartitions("bucket", KEY, *CALL_COLUMNS)
     .observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.partitionBy("bucket").parquet(staging))
    fs, _ = _file_system(spark, staging)
    Path = spark._jvm.org.apache.hadoop.fs.Path
    written = 0
    for status in _listing(spark, f"{staging}/bucket=*/*.parquet"):
        source = status.getPath()
        target = Path(f"{path}/{MERGED}/{source.getParent().getName()}")
        fs.mkdirs(target)
        fs.rename(source, Path(target, f"part-{uuid.uuid4().hex}.parquet"))
        written += 1
    for _, name in small:
        fs.delete(Path(name), False)
    for name in rounds:
        fs.delete(Path(name), True)
    fs.delete(Path(staging), True)
    return MergeReport(len(rounds), len(small), written, int(seen.get["rows"]))


def append_attempts(log: DataFrame, path: str, **metrics) -> tuple[DataFrame, dict]:
    """Append one round of calls; returns a scan of what was written, and aggregates over it.

    Each task's replies are in the log when the task ends, so a crash costs the calls of the
    tasks that were running.
    """
    own = f"{path.rstrip('/')}/round-{uuid.uuid4().hex}"
    seen = Observation()
    observed = log.observe(seen, *[value.alias(name) for name, value in metrics.items()]) if metrics else log
    observed.write.options(**_KEEP_FINISHED_TASKS).parquet(own)
    return log.sparkSession.read.schema(log.schema).parquet(own), (seen.get if metrics else {})


def reusable(log: DataFrame, keys: DataFrame, errors: bool = True) -> DataFrame:
    """What the log knows of ``keys``: one row per key and call, to be used instead of a call.

    Replies always count. Errors count too, since the run that met them did not store the row, but not
    daily quota errors, which may be over, and none with ``errors`` false.
    """
    good = F.col("err").isNull()
    if errors:
        good = good | ~is_daily(F.col("err"))
    known = log.filter(F.col("called") & good).join(keys.select(KEY).distinct(), KEY, "left_semi")
    answer = F.struct("ended_at", "resp", "err")
    return known.groupBy(KEY, *CALL_COLUMNS).agg(F.max(answer).alias("_answer")).select(KEY, *CALL_COLUMNS, "_answer.*")


def response_text(df: DataFrame, raw: str = "response", name: str = "resp") -> DataFrame:
    """Add the text of a raw JSON response: all non-empty part texts, joined."""
    parsed = F.from_json(F.col(raw), RESPONSE_SCHEMA)
    parts = F.transform(
        parsed.getField("candidates"),
        lambda c: F.transform(c.getField("content").getField("parts"), lambda p: p.getField("text")),
    )
    return df.withColumn(name, reply_text(parts))
