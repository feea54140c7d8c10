"""The result table: column list, order, and rows for good and failed outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from glossa.functions.cells import json_text
from glossa.functions.reply import parse_reply_json, reply_struct
from glossa.operators.attempts import UNKNOWN_ERROR
from glossa.operators.media import NO_URL_ERROR
from glossa.schema_spec import FieldSpec

# Names of the result columns around the reply fields.
HEAD_COLUMNS = ["vlm_content_key", "vlm_url_used", "vlm_model_used", "vlm_download_error_before_url"]
TAIL_COLUMNS = ["vlm_full_response_json", "vlm_error", "vlm_processed_at"]
ANNOTATION_COLUMNS = ["vlm_annotation_json", "vlm_annotation_error", "vlm_annotation_model_used"]


def result_columns(spec: tuple[FieldSpec, ...], annotation: list[str] | None = None) -> list[str]:
    fields = [f"vlm_{f.name}" for f in spec]
    return [*HEAD_COLUMNS, *fields, *TAIL_COLUMNS, *(annotation or [])]


def column_order(source: list[str], added: list[str]) -> list[str]:
    """Source columns as they come, then every ``vlm_`` column sorted."""
    every = list(dict.fromkeys([*source, *added]))
    own = [c for c in every if not c.startswith("vlm_")]
    return own + sorted(c for c in every if c.startswith("vlm_"))


def project_to(df: DataFrame, columns: list[str], types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Exactly ``columns``: absent ones null, others dropped."""
    types = types or {}
    return df.select(
        *[
            F.col(f"`{c}`") if c in df.columns
            else F.lit(None).cast(types.get(c, T.StringType())).alias(c)
            for c in columns
        ]
    )


def empty_results(spark: SparkSession, source: T.StructType, spec: tuple[FieldSpec, ...],
                  annotation: list[str] | None = None) -> DataFrame:
    """No rows, all result columns."""
    have = set(source.fieldNames())
    types = {f"vlm_{f.name}": f.data_type for f in spec} | {"vlm_processed_at": T.TimestampType()}
    extra = [
        T.StructField(c, types.get(c, T.StringType()))
        for c in result_columns(spec, annotation) if c not in have
    ]
    return spark.createDataFrame([], T.StructType([*source.fields, *extra]))


def with_analysis(df: DataFrame, spec: tuple[FieldSpec, ...], resp: str = "resp", parsed: str | None = None) -> DataFrame:
    """Add ``analysis``: the typed reply, null where there is none.

    ``parsed`` names a column that already holds the parsed reply; ``resp`` is parsed otherwise.
    """
    if parsed is not None:
        return df.withColumn("analysis", F.when(F.col(resp).isNotNull(), reply_struct(F.col(parsed), spec)))
    made = with_analysis(df.withColumn("_parsed", parse_reply_json(F.col(resp))), spec, resp, "_parsed")
    return made.drop("_parsed")


def failure_message(error: Column, download_error: Column) -> Column:
    """Error text of a failed row; a failed download comes first."""
    base = F.coalesce(F.nullif(error, F.lit("")), F.lit(UNKNOWN_ERROR))
    after = F.concat(F.lit("File download failed ("), download_error, F.lit("). URL-only: "), base)
    return F.when(F.coalesce(download_error, F.lit("")) != "", after).otherwise(base)


def result_rows(df: DataFrame, source: list[str], spec: tuple[FieldSpec, ...],
                processed_at: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result rows from ``analysis``, ``url_used``, ``err``, ``model_used``, ``download_error``.

    ``source`` are the input columns to carry (the content key among them).
    """
    no_url = F.col("url_used") == "None"
    ok = F.col("analysis").isNotNull()
    download = F.when(no_url, None).otherwise(F.col("download_error"))
    error = F.when(no_url, NO_URL_ERROR).otherwise(F.col("err"))
    new = {
        "vlm_url_used": F.col("url_used"),
        "vlm_model_used": F.when(~no_url, F.col("model_used")),
        "vlm_download_error_before_url": download,
        **{f"vlm_{f.name}": F.col("analysis").getField(f.name) for f in spec},
        "vlm_full_response_json": F.when(ok, json_text(F.col("analysis"))),
        "vlm_error": F.when(~ok, failure_message(error, download)),
        "vlm_processed_at": processed_at if processed_at is not None else F.current_timestamp(),
    }
    carried = [F.col(f"`{c}`") for c in source if c not in new]
    return df.select(*carried, *[c.alias(n) for n, c in new.items()], *keep)


def run_summary(results: DataFrame, by: str = "platform") -> DataFrame:
    """Rows written per group and status; one hash aggregate."""
    status = F.when(F.col("vlm_error").isNull(), "ok").otherwise("error")
    return results.groupBy(F.col(by), status.alias("status")).agg(F.count("*").alias("n_rows"))
