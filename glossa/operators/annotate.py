"""Second-pass columns from second-pass outcomes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions.cells import json_text
from glossa.functions.prompts import annotation_prompt, first_url, row_metadata
from glossa.operators.results import ANNOTATION_COLUMNS


def default_columns(reply: Column, error: Column, model: Column) -> dict[str, Column]:
    has_reply = reply.isNotNull()
    values = [json_text(reply), F.when(~has_reply, error), model]
    return dict(zip(ANNOTATION_COLUMNS, values))


def apply_model_and_error(columns: dict[str, Column], reply: Column, error: Column, model: Column) -> dict[str, Column]:
    """``*_model_used`` is always the call's model; without a reply, empty ``*_error`` takes its error."""
    out = dict(columns)
    for name, value in columns.items():
        if name.endswith("_model_used"):
            out[name] = model
        elif name.endswith("_error"):
            unset = reply.isNull() & (F.coalesce(error, F.lit("")) != "")
            empty = F.coalesce(value.cast("string"), F.lit("")) == ""
            out[name] = F.when(unset & empty, error).otherwise(value)
    return out


def _url(df: DataFrame) -> Column:
    if "call_url" in df.columns:
        return F.col("call_url")
    return first_url(*[F.col(c) if c in df.columns else F.lit("") for c in ("post_url", "media_url")])


def second_pass_rows(df: DataFrame, gate: Column) -> DataFrame:
    """Gated rows with the URL of the call; rows with neither media nor URL are left out.

    Needs ``analysis`` and ``media_fname``.
    """
    rows = df.filter(gate).withColumn("call_url", _url(df))
    return rows.filter(F.col("media_fname").isNotNull() | F.col("call_url").isNotNull())


def second_prompt(
    df: DataFrame,
    template: str | None,
    key: str = "vlm_content_key",
    own: Callable[[Column, Column, Column], Column] | None = None,
    drop: tuple[str, ...] = (),
) -> Column:
    """Second-pass prompt over the columns of ``df``: an own builder's, else the template's.

    ``own`` gets key, analysis and row metadata. ``drop`` are columns that are not metadata.
    """
    metadata = row_metadata(df, drop=("analysis", *drop))
    if own is not None:
        return own(F.col(key), F.col("analysis"), metadata)
    if template is None:
        raise ValueError("the second pass needs a template or a prompt builder")
    return annotation_prompt(template, F.col(key), F.col("analysis"), metadata, _url(df))


def annotate(
    df: DataFrame,
    outcomes: DataFrame,
    on: str,
    columns: Callable[..., dict[str, Column]] | None = None,
    drop: tuple[str, ...] = (),
    key: str = "vlm_content_key",
) -> DataFrame:
    """Add annotation columns; rows without a second-pass outcome get blanks.

    ``outcomes`` has one row per value of ``on``: ``k``, ``err``, ``model_used`` and the
    typed ``reply``. ``columns`` is an own builder, see ``glossa.hooks``; it sees the
    whole row but for ``drop``.
    """
    second = outcomes.select(
        F.col("k").alias(on),
        F.lit(True).alias("_called"),
        F.col("reply").alias("_reply"),
        F.col("err").alias("_err"),
        F.col("model_used").alias("_model"),
    )
    joined = df.join(second, on, "left")
    reply, error, model = F.col("_reply"), F.col("_err"), F.col("_model")
    if columns is None:
        made = default_columns(reply, error, model)
    else:
        made = columns(
            reply=reply,
            row=F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in drop]),
            analysis=F.col("analysis"),
            key=F.col(key),
            media=F.col("media_path" if "media_path" in df.columns else "media_fname"),
            called=F.coalesce(F.col("_called"), F.lit(False)),
        )
    made = apply_model_and_error(made, reply, error, model)
    blanks = {name: F.when(F.col("_called"), value) for name, value in made.items()}
    return joined.withColumns(blanks).drop("_called", "_reply", "_err", "_model")


def annotation_column_names(columns: Callable[..., dict[str, Column]] | None) -> list[str]:
    """Names an own builder makes. It only builds expressions, so nothing runs here."""
    if columns is None:
        return list(ANNOTATION_COLUMNS)
    if hasattr(columns, "names"):
        return list(columns.names)
    nothing = F.lit(None)
    return list(columns(reply=nothing, row=nothing, analysis=nothing, key=nothing,
                        media=nothing, called=nothing))
