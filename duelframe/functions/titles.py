"""What a title says: its part number, the two names, whether it is a battle."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelframe.functions import patterns as P
from duelframe.functions.text import holds, non_empty, replace, split_first, strip


def clean_title(c: Column) -> Column:
    """Stripped, then without quotes around the whole; inner spaces stay."""
    return replace(strip(c.cast("string")), '^"(.*)"$', "$1", flags="dU")


def base_title(c: Column) -> Column:
    """Without a trailing part number; null for a null."""
    return strip(replace(strip(c), P.PART))


def part_number(c: Column) -> Column:
    """N of a trailing "pt. N", sought in the text as it is; null without one."""
    return F.when(is_part(c), F.regexp_extract(c, f"(?idU){P.PART}", 1).try_cast("int"))  # to cast "" would cost an exception


def is_part(c: Column) -> Column:
    return holds(c, P.PART, flags="idU")


def matchup(title: Column, league: str = P.LEAGUE) -> Column:
    """"A vs B" of a title, or null if a side is missing.

    The league's prefix goes, the rest is parted at the first "vs" between spaces,
    and the right side loses what follows @, |, ( or *, and then a number at its end.
    """
    sides = split_first(replace(strip(title), P.title_prefix(league)), P.VERSUS)
    left = non_empty(strip(F.get(sides, F.lit(0))))
    right = replace(strip(F.get(sides, F.lit(1))), P.AFTER_NAME, flags="dU")
    right = non_empty(strip(replace(right, P.TRAILING_NUMBER, flags="dU")))
    return F.concat(left, F.lit(" vs "), right)


def without_annotation(c: Column) -> Column:
    """Without what follows the first hyphen between spaces."""
    return replace(c, P.ANNOTATION, flags="dU")


def side(c: Column, k: int) -> Column:
    """The k-th side, 0 or 1, of a matchup; null if there is none."""
    return strip(F.get(split_first(c, P.VERSUS), F.lit(k)))


def canonical(c: Column, names: Mapping[str, str]) -> Column:
    """Stripped, and replaced if it is an alias; exact, and not chained."""
    plain = strip(c.cast("string"))
    if not names:
        return plain
    return F.coalesce(F.try_element_at(F.create_map(*map(F.lit, chain(*names.items()))), plain), plain)


def canonical_any_case(c: Column, names: Mapping[str, str]) -> Column:
    """canonical() in any case, empty for a null; of aliases that differ in case only, the last counts."""
    plain = strip(F.coalesce(c.cast("string"), F.lit("")))
    if not names:
        return plain
    lower = {k.lower(): v for k, v in names.items()}
    return F.coalesce(F.try_element_at(F.create_map(*map(F.lit, chain(*lower.items()))), F.lower(plain)), plain)


def names_versus(title: Column) -> Column:
    return holds(title, P.WORD_VS)


def is_excluded(title: Column) -> Column:
    """Holds one of the keywords, anywhere; false for a null."""
    return holds(F.lower(title), P.excluded(), flags="d")


def is_one_on_one(title: Column) -> Column:
    """Not a team battle by the signs of its title; false for a null."""
    # one pattern, as a filter that moves below the title's cleaning repeats that for each mention of the title
    return F.coalesce(~F.lower(title).rlike(f"(?sU){P.TEAM}"), F.lit(False))


def is_battle(title: Column) -> Column:
    """names_versus, not is_excluded, and is_one_on_one, in one look at the title.

    Catalyst moves filters below the cleaning of titles and repeats the cleaning for
    each mention, so a chain filters by this, which names the title once. Plain
    searches come first, and spare most titles most of the patterns.
    """
    found = lambda x, pattern: x.rlike(f"(?sU){pattern}")

    def looks_so(x: Column) -> Column:
        none = [~x.contains(w) for w in (*P.excluded_words(), "/", "+")]
        twice = [~(x.contains(w) & found(x, rf"{one}.*{one}")) for w, one in (("vs", P.WORD_VS), ("and", P.WORD_AND))]
        return reduce(Column.__and__, [x.contains("vs"), *none, found(x, P.WORD_VS), *twice, ~(x.contains("on") & found(x, P.N_ON_M))])

    return F.coalesce(F.get(F.transform(F.array(F.lower(title)), looks_so), F.lit(0)), F.lit(False))
