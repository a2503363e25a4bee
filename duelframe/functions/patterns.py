"""Patterns and word lists.

Patterns are written for Java: (?U) gives white space, word boundaries and case their
Unicode meaning, and (?d) makes the newline the only line end. The league whose
titles are read is a parameter, a pattern-quoted name.
"""

from __future__ import annotations

import re

#: The league that titles and descriptions name; pass another to the functions that take one.
LEAGUE = "Bar League"

# The patterns of titles.
PART = r"\s*pt\.?\s*(\d+)$"
VERSUS = r"\s+vs\s+"
AFTER_NAME = r"\s*[@|(*].*$"
TRAILING_NUMBER = r"\s+\d+$"
ANNOTATION = r"\s-\s.*$"
WORD_VS = r"\bvs\b"
WORD_AND = r"\band\b"
N_ON_M = r"\b\d+\s*on\s*\d+\b"
TEAM = rf"{WORD_VS}.*{WORD_VS}|{WORD_AND}.*{WORD_AND}|/|\+|{N_ON_M}"

# Titles with one of these, in any case, aren't battles.
EXCLUDED = [
    "tryout", "tryouts", "beatbox", "beat box", "flyer", "promo", "promos",
    "anygma machine", "unggoyan", "pre-battle interviews", "interview", "interviews",
    "salitang ugat", "trailer", "video flyer", "[live]", "silip", "sound check",
    "tribute", "anniversary party", "tutok", "review", "abangan",
]

# Month names, a day or range of days, and a year.
MONTH = (
    r"(Jan(?:uary)?\.?|Feb(?:ruary)?\.?|Mar(?:ch)?\.?|Apr(?:il)?\.?|May\.?|"
    r"Jun(?:e)?\.?|Jul(?:y)?\.?|Aug(?:ust)?\.?|Sep(?:t\.?|tember)\.?|"
    r"Oct(?:ober)?\.?|Nov(?:ember)?\.?|Dec(?:ember)?\.?)"
)
DATE = MONTH + r"\s+(\d{1,2})(?:\s*-\s*\d{1,2})?\s*,\s*(\d{4})"

# What a CSV has for null.
NA_TOKENS = ["", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]


def title_prefix(league: str) -> str:
    return rf"^{league}(?: [^–-]+)?\s*[-–]\s*"


def location_prefix(league: str) -> str:
    return rf"^({league}(?: Battle League)?(?: presents)?[:\-]?\s*)"


def event_name(league: str) -> str:
    return rf"{league}\s+presents\s*:?\s*(.+?)\s*@"


def excluded_words() -> list[str]:
    """The keywords without those that hold another of the list, which add nothing to it."""
    return [w for w in dict.fromkeys(EXCLUDED) if not any(v != w and v in w for v in EXCLUDED)]


def excluded() -> str:
    """A pattern for lower-case titles."""
    return "|".join(map(re.escape, excluded_words()))
