"""Media store lookup and the choice of what a row is scored on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossa.functions.text import media_save_name, with_clean_urls

NO_URL_ERROR = "No media_url or post_url available to download."

def resolve_media(manifest: DataFrame) -> DataFrame:
    """One file per save name: a non-empty ``<name>.mp4``, else the first non-empty ``<name>*``.

    A ``path`` column of the manifest, where a file really is, goes along.
    """
    name, fname = F.col("save_name"), F.col("fname")
    is_mp4 = fname == F.concat(name, F.lit(".mp4"))
    path = F.col("path") if "path" in manifest.columns else F.lit(None).cast("string")
    file = F.struct(fname.alias("media_fname"), path.alias("media_path"))
    return (
        manifest.filter((F.col("size") > 0) & fname.startswith(name))
        .groupBy("save_name")
        .agg(F.coalesce(F.min(F.when(is_mp4, file)), F.min(file)).alias("_file"))
        .select("save_name", "_file.*")
    )


def dispatch_url(df: DataFrame) -> DataFrame:
    """Add ``call_url``, ``url_role`` (post, media or null) and ``save_name``.

    The first URL present decides: a post URL whose file is missing never falls back
    to the media URL.
    """
    urls = {
        name: F.col(column) if column in df.columns else F.lit("")
        for name, column in (("_post", "post_url"), ("_media", "media_url"))
    }
    has_post, has_media = F.col("_post") != "", F.col("_media") != ""
    return (
        with_clean_urls(df, urls)
        .withColumns(
            {
                "call_url": F.when(has_post, F.col("_post")).when(has_media, F.col("_media")),
                "url_role": F.when(has_post, "post").when(has_media, "media"),
            }
        )
        .withColumn("save_name", media_save_name(F.col("call_url"), F.col("url_role")))
        .drop("_post", "_media")
    )


def join_by_name(df: DataFrame, right: DataFrame, spread_by: str) -> DataFrame:
    """Left join on ``save_name``; rows without one stay spread out instead of meeting in one task."""
    # Join keys that match nothing, several for each task of the join.
    keys = 16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    nothing = F.concat(F.lit("?"), F.pmod(F.xxhash64(spread_by), F.lit(keys)).cast("string"))
    keyed = df.withColumn("_name", F.coalesce(F.col("save_name"), nothing))
    return keyed.join(right.withColumnRenamed("save_name", "_name"), "_name", "left").drop("_name")


def with_route(df: DataFrame) -> DataFrame:
    """Add ``url_used``: the role for a media call, ``url`` for a URL-only call, ``None`` for neither."""
    role = (
        F.when(F.col("media_fname").isNotNull(), F.col("url_role"))
        .when(F.col("call_url").isNotNull(), F.lit("url"))
        .otherwise(F.lit("None"))
    )
    return df.withColumn("url_used", role)
