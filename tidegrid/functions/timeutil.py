"""Instants are BIGINT milliseconds since the epoch, UTC; durations are signed BIGINT milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND, MINUTE, HOUR, DAY = 1000, 60_000, 3_600_000, 86_400_000
INTERVAL = 15 * MINUTE


def from_iso(text: Column) -> Column:
    """Milliseconds (floored) of an ISO text with a date, seconds and an offset; null without these or if malformed.

    A lower-case z is no offset, as in the standard parsers.
    """
    text = F.trim(text)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(?:Z|[+-]\d{2}:?\d{2})$"), F.unix_millis(F.try_to_timestamp(text)))


def feature_time(ms: Column) -> Column:
    """An instant as feature stores write it, with nine decimals."""
    return F.concat(F.substring(to_iso(ms), 1, 23), F.lit("000000Z"))


def from_feature_time(text: Column) -> Column:
    """Milliseconds of an instant written with three decimals or more."""
    return from_iso(F.concat(F.substring(text, 1, 23), F.lit("Z")))


def to_iso(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def floor_to(ms: Column, span: int) -> Column:
    if span <= 0:
        raise ValueError("a span is positive")
    return ms - F.pmod(ms, F.lit(span))


def duration_text(ms: Column) -> Column:
    """10d 14h 30m; 0ms; a leading minus for negative durations."""
    a = F.abs(ms)
    units = [("d", F.call_function("div", a, F.lit(DAY))), ("h", F.call_function("div", a % DAY, F.lit(HOUR))), ("m", F.call_function("div", a % HOUR, F.lit(MINUTE))), ("s", F.call_function("div", a % MINUTE, F.lit(SECOND))), ("ms", a % SECOND)]
    parts = F.concat_ws(" ", *[F.when(v > 0, F.concat(v.cast("string"), F.lit(u))) for u, v in units])
    return F.when(ms == 0, "0ms").otherwise(F.concat(F.when(ms < 0, "-").otherwise(""), parts))
