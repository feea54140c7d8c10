"""Prompt texts, assembled per row from driver-side templates."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossa.functions.cells import json_text
from glossa.functions.text import clean_url

NO_URL = "(none)"

# What is added to a prompt.
URL_ONLY_LEAD = "We could not download the media. Please analyze based on the following URL: "
URL_ONLY_TAIL = "If you cannot access or analyze the content from this URL, return an error."
ORIGINAL_URL = "Original URL: "


def media_prompt(prompt: Column, url: Column) -> Column:
    """Prompt of a call with media; the source URL is added where there is one."""
    has_url = F.coalesce(url, F.lit("")) != ""
    added = F.concat(prompt, F.lit(f"\n\n{ORIGINAL_URL}"), url, F.lit("\n"))
    return F.when(has_url, added).otherwise(prompt)


def url_prompt(prompt: Column, url: Column) -> Column:
    """Prompt of a call that only names the URL."""
    return F.concat(prompt, F.lit(f"\n\n{URL_ONLY_LEAD}"), url, F.lit(f"\n{URL_ONLY_TAIL}"))


def first_url(post_url: Column, media_url: Column) -> Column:
    """Cleaned post URL, else cleaned media URL, else null."""
    return F.coalesce(
        F.nullif(clean_url(post_url), F.lit("")), F.nullif(clean_url(media_url), F.lit(""))
    )


def fill_template(template: str, slots: dict[str, Column]) -> Column:
    """``str.format`` with named slots; doubled braces stand for themselves."""
    pieces: list[Column] = []
    for text, name, spec, conversion in Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if name is None:
            continue
        if name not in slots or spec or conversion:
            raise ValueError(f"template slot {{{name}}} is not one of {sorted(slots)}")
        pieces.append(slots[name])
    return F.concat(*pieces) if pieces else F.lit("")


def row_metadata(df: DataFrame, drop: tuple[str, ...] = ()) -> Column:
    """The row's own columns (no ``vlm_`` ones) as one struct."""
    names = [c for c in df.columns if not c.startswith("vlm_") and c not in drop]
    return F.struct(*[F.col(f"`{c}`") for c in names])


def annotation_prompt(
    template: str, key: Column, analysis: Column, metadata: Column, url: Column
) -> Column:
    """Second-pass prompt: key and prior analysis, row metadata and URL in a template."""
    bundle = F.struct(key.alias("vlm_content_key"), analysis.alias("prior_analysis"))
    return fill_template(
        template,
        {
            "post_id_and_prior_json": json_text(bundle),
            "row_metadata_json": json_text(metadata),
            "canonical_post_url": F.coalesce(url, F.lit(NO_URL)),
        },
    )
