"""Classes of call errors, by message text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks looked for anywhere in the message, in any case.
RETRYABLE_MARKS = r"(?i)500|internal|failed to convert server response to json"
EXHAUSTED_MARKS = r"(?i)429|resource exhausted|resource_exhausted|quota|rate limit"
NOT_PER_MINUTE_MARKS = r"(?i)per_day|perday"
DAILY_MARKS = r"(?i)per_day|perday|per-day"
SPELLED_DAY = r"(?i)per day"
SPELLED_LIMIT = r"(?i)quota|limit"
DELAY_SECONDS = r"(?i)retry in (\d+\.?\d*)s\b"
DELAY_HOURS = r"(?i)retry in (\d+)h(\d+)m(\d+\.?\d*)s"

LONG_DELAY_SEC = 3600


def _group(message: Column, pattern: str, group: int) -> Column:
    # No match gives '', which is no number.
    return F.regexp_extract(message, pattern, group).try_cast("double")


def _known(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def is_retryable(message: Column) -> Column:
    return _known(message.rlike(RETRYABLE_MARKS))


def is_exhausted(message: Column) -> Column:
    return _known(message.rlike(EXHAUSTED_MARKS))


def retry_delay(message: Column) -> Column:
    """Seconds asked for by ``retry in 35.2s`` or ``retry in 1h2m3s``, else null."""
    long_form = (
        _group(message, DELAY_HOURS, 1) * 3600
        + _group(message, DELAY_HOURS, 2) * 60
        + _group(message, DELAY_HOURS, 3)
    )
    return F.coalesce(_group(message, DELAY_SECONDS, 1), long_form)


def is_per_minute(message: Column) -> Column:
    """A rate limit that clears within the hour."""
    other = ~message.rlike(NOT_PER_MINUTE_MARKS)
    return _known(message.rlike(EXHAUSTED_MARKS) & other & (retry_delay(message) < LONG_DELAY_SEC))


def is_daily(message: Column) -> Column:
    """A quota that only clears after hours; null is not one."""
    spelled = message.rlike(SPELLED_DAY) & message.rlike(SPELLED_LIMIT)
    long_wait = _known(retry_delay(message) >= LONG_DELAY_SEC)
    return _known(message.rlike(EXHAUSTED_MARKS) & (message.rlike(DAILY_MARKS) | spelled | long_wait))


def with_error_class(df: DataFrame, message: str = "err", prefix: str = "") -> DataFrame:
    """Add the four tests and the delay as columns, each computed once."""
    m = F.col(message)
    return df.withColumns(
        {
            f"{prefix}retryable": is_retryable(m),
            f"{prefix}exhausted": is_exhausted(m),
            f"{prefix}per_minute": is_per_minute(m),
            f"{prefix}daily": is_daily(m),
            f"{prefix}delay_sec": retry_delay(m),
        }
    )
