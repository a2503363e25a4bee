"""What an event's description says: its date, place and name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelframe.functions import patterns as P
from duelframe.functions.text import collapse, non_empty, replace, strip, strip_set

#: A look at the first letter spares most places the months' names.
_DATE = rf"(?=[jfmasond]){P.DATE}"
_BEFORE_DATE = rf"(?idUs)^(.*?){_DATE}.*$"
#: Of a date: the month's first letters, the first day and the year.
_MONTHS = "JANFEBMARAPRMAYJUNJULAUGSEPOCTNOVDEC"
_PARTS = r"(?sU)^(\w\w\w)\D*(\d+).*?(\d{4})\z"


def event_date(description: Column) -> Column:
    """The first date, the first day of a range, at midnight; null if there is none or it isn't in the calendar.

    Years are those of a 64-bit count of nanoseconds, 1678 to 2261.
    """
    text = F.regexp_substr(description, F.lit(f"(?iU){_DATE}"))

    def day(x: Column) -> Column:
        """Of a text like Dec2024-20; a cast to a date costs less than a formatter, which throws what it can't read."""
        month = (F.position(F.upper(F.substr(x, F.lit(1), F.lit(3))), F.lit(_MONTHS)) + F.lit(2)) / 3
        return F.concat(F.substr(x, F.lit(4), F.lit(5)), month.cast("int").cast("string"), F.lit("-"), F.substr(x, F.lit(9))).try_cast("date")

    # the lambdas name what they are given once each, where conditions would compute it anew
    days = F.transform(F.array(F.regexp_replace(text, _PARTS, "$1$3-$2")), day)
    return F.get(F.filter(days, lambda d: F.year(d).between(1678, 2261)), F.lit(0)).cast("timestamp_ntz")


def split_location(description: Column) -> Column:
    """What stands before the date and after the last colon; the whole text without a date; null if empty."""
    marked = F.regexp_replace(description, _BEFORE_DATE, "$1\0")
    return non_empty(strip(F.regexp_replace(marked, r"(?s)^(?:.*:)?\s*[ .]*(.*?)[ .]*\s*\x00\z", "$1")))


def clean_location(location: Column, league: str = P.LEAGUE) -> Column:
    """What follows the last @, or else the last sentence end, without the league's prefix and odd punctuation; null if empty."""
    place = strip(F.regexp_replace(strip(location), r"(?s)^(?:.*@|(?!.*@).*[.!?])", ""))
    place = replace(place, P.location_prefix(league), flags="iU")
    return non_empty(strip_set(collapse(place), " \t\n\r-–,.;:"))


def event_name(description: Column, league: str = P.LEAGUE) -> Column:
    """What stands between the league's "presents" and the first @ after it; null if empty."""
    found = F.regexp_extract(collapse(description), f"(?idU){P.event_name(league)}", 1)
    return non_empty(strip_set(strip(found), " -–—"))
