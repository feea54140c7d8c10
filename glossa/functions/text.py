"""Cleaning of text cells, URLs and keys, as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's ``str.strip`` removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: the separator between key parts.
KEY_SEPARATOR = "\x1f"

# Hosts whose URLs are rewritten, looked for anywhere in lower-case text.
X_HOSTS = r"x\.com|twitter\.com"

# Media type per file extension.
MIME_BY_EXTENSION = {
    ".mp4": "video/mp4",
    ".webm": "video/webm",
    ".mov": "video/quicktime",
    ".avi": "video/x-msvideo",
    ".mkv": "video/x-matroska",
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".gif": "image/gif",
    ".webp": "image/webp",
    ".bmp": "image/bmp",
    ".svg": "image/svg+xml",
}
MIME_DEFAULT = "application/octet-stream"

# Hosts that belong to each family (and all their sub-domains).
HOST_FAMILIES = {
    "ig": ["instagram.com"],
    "fb": ["facebook.com", "fb.com", "fb.watch", "fb.me"],
}

CLIP_LIMIT = 6000
CLIP_URL_LIMIT = 280


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(c, F.lit(WHITESPACE))


def _stripped(c: Column) -> Column:
    return strip(F.coalesce(c.cast("string"), F.lit("")))


def _without_nan(s: Column) -> Column:
    return F.when(F.lower(s) == "nan", "").otherwise(s)


def _rewrite_status(u: Column) -> Column:
    old, new = F.lit("/statuses/"), F.lit("/status/")
    rewrite = u.contains("/statuses/") & F.lower(u).rlike(X_HOSTS)
    return F.when(rewrite, F.replace(u, old, new)).otherwise(u)


def clean_text(c: Column) -> Column:
    """Stripped text; null, NaN and the word ``nan`` in any case become ``''``."""
    return _without_nan(_stripped(c))


def normalize_url(c: Column) -> Column:
    """Stripped URL; ``/statuses/`` becomes ``/status/`` where the text mentions the X hosts."""
    return _rewrite_status(_stripped(c))


def with_clean_urls(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns holding ``normalize_url`` of ``clean_text`` of the given ones.

    One projection per step: nested in one expression, every step would copy the one
    before into each of its branches.
    """
    for step in (_stripped, _without_nan, _rewrite_status):
        df = df.withColumns({name: step(value) for name, value in columns.items()})
        columns = {name: F.col(name) for name in columns}
    return df


def clean_url(c: Column) -> Column:
    """``normalize_url`` of ``clean_text`` as one expression, for single columns."""
    return _rewrite_status(clean_text(c))


def content_key(parts: list[Column]) -> Column:
    """SHA-256 (hex) over cleaned key parts, none of them null (a null would be skipped).

    Declared non-null, or joins on it would test the whole expression for null at the scan.
    """
    return F.coalesce(F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256), F.lit(""))


def media_save_name(url: Column, role: Column | str) -> Column:
    """Folder name of a URL in the media store; ``post`` pages get their own suffix.

    Null where the URL or the role is.
    """
    role = F.lit(role) if isinstance(role, str) else role
    digest = F.sha2(F.concat(role, F.lit("\n"), strip(url)), 256)
    return F.concat(F.substring(digest, 1, 16), F.when(role == "post", "_post").otherwise(""))


def url_host(c: Column) -> Column:
    """Lower-cased host of a URL, ``https`` assumed; ``''`` where there is none."""
    u = F.translate(strip(F.coalesce(c, F.lit(""))), "\t\r\n", "")
    u = F.regexp_replace(u, r"(?s)\A(?!.*://)(?=.)", "https://")
    authority = F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.lower(F.regexp_extract(authority, r"^(?:.*@)?([^:@]*)", 1))


def host_family(c: Column) -> Column:
    """``ig``, ``fb`` or null, by exact host or dot suffix."""
    host = url_host(c)
    names = {
        family: "|".join(re.escape(d) for d in domains) for family, domains in HOST_FAMILIES.items()
    }
    return F.coalesce(
        *[F.when(host.rlike(rf"\A(.*\.)?({domains})\z"), family) for family, domains in names.items()]
    )


def mime_type(path: Column) -> Column:
    """Media type by file extension, from a fixed map so that every host agrees."""
    ext = F.lower(F.regexp_extract(path, r"(?:^|/)\.*[^/.][^/]*(\.[^./]*)$", 1))
    table = F.create_map(*[F.lit(x) for pair in MIME_BY_EXTENSION.items() for x in pair])
    return F.when(path.isNotNull(), F.coalesce(F.element_at(table, ext), F.lit(MIME_DEFAULT)))


def shorten(c: Column, limit: int) -> Column:
    """Stripped text, cut to ``limit`` characters ending in ``...``."""
    too_long = rf"(?s)\A(.{{{limit - 3}}}).{{4,}}\z"
    return F.regexp_replace(strip(F.coalesce(c, F.lit(""))), too_long, "$1...")


def clip_text(c: Column, limit: int = CLIP_LIMIT) -> Column:
    return shorten(c, limit)


def quoted(c: Column) -> Column:
    """Text in quotes as Python shows it: single quotes unless only those occur inside."""
    body = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for raw, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        body = F.replace(body, F.lit(raw), F.lit(shown))
    double = c.contains("'") & ~c.contains('"')
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(single)


def url_context(url: Column) -> Column:
    """``url='…'`` as added to failure messages, the URL cut to 280 characters."""
    return F.concat(F.lit("url="), quoted(shorten(url, CLIP_URL_LIMIT)))


def download_error(video: Column, image: Column) -> Column:
    """Message for a URL where both kinds of download failed."""
    return F.format_string(
        "Both video (Error: %s) and image (Error: %s) downloads failed.", video, image
    )
