"""Times and durations, independent of the session's time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"([0-9]+(?:[.,][0-9]+)?)"
#: Sign, then weeks, days, hours, minutes, seconds; years and months only if they are 0.
_DURATION = rf"^([+-])?P(?!\b)(?:0+(?:[.,]0+)?Y)?(?:0+(?:[.,]0+)?M)?(?:{_NUMBER}W)?(?:{_NUMBER}D)?(?:T(?:{_NUMBER}H)?(?:{_NUMBER}M)?(?:{_NUMBER}S)?)?\z"
_SECONDS = (604800.0, 86400.0, 3600.0, 60.0, 1.0)
_DATE_ALONE, _TIME_WITHOUT_ZONE = r"^\s*(\d{4}-\d{2}-\d{2})\s*$", r"^\s*([^T ]+[T ][^Z+-]*?)\s*$"


def utc_timestamp(c: Column) -> Column:
    """An ISO time as a timestamp without zone, in UTC; null if it can't be read. Texts without an offset are UTC."""
    zoned = F.regexp_replace(F.regexp_replace(c.cast("string"), _DATE_ALONE, "$1T00:00:00Z"), _TIME_WITHOUT_ZONE, "$1Z")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(zoned).cast("timestamp_ntz"))


def format_of(c: Column) -> Column:
    """What a time's text looks like: 0 for each digit, and one mark for fractions and for offsets of any length."""
    text = F.regexp_replace(F.regexp_replace(c.cast("string"), r"[.,]\d+", ".f"), r"(?:Z|[+-]\d{2}:?\d{2})$", "z")
    return F.regexp_replace(text, r"\d", "0")


def duration_seconds(c: Column) -> Column:
    """Seconds of an ISO-8601 duration; null if it is none, or counts years or months."""
    # one match marks the text and parts its numbers; what isn't a duration stays unmarked
    told = F.translate(F.regexp_replace(c, _DURATION, "\x01$2;$3;$4;$5;$6"), ",\x01", ".;")
    number = lambda k: F.concat(F.lit("0"), F.split_part(told, F.lit(";"), F.lit(k + 2))).try_cast("double")  # noqa: E731  "" would cost an exception
    seconds = sum((number(k) * s for k, s in enumerate(_SECONDS[1:], 1)), number(0) * _SECONDS[0])
    marked = F.startswith(told, F.lit(";")) & ~F.startswith(c, F.lit(";")) & (told != ";;;;;")
    return F.when(marked, F.when(F.startswith(c, F.lit("-")), -seconds).otherwise(seconds))


def clock(seconds: Column) -> Column:
    """HH:MM:SS as on a clock: whole seconds, and 24 hours begin again at 00:00:00."""
    s = F.pmod(F.floor(seconds), F.lit(86400))
    two = lambda x: F.lpad(F.floor(x).cast("string"), 2, "0")
    return F.concat(two(s / 3600), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60))
