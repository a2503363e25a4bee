"""Views for manual work: battles without a date, and the winners' worksheet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

URL_MARK = " | "


def quarantine(battles: DataFrame) -> DataFrame:
    """Battles without a trusted date."""
    return battles.where(F.col("event_date").isNull())


def quarantined_events(battles: DataFrame) -> DataFrame:
    """Their events' names, once each, null included."""
    return quarantine(battles).select("event_name").distinct()


def winner_review(battles: DataFrame) -> DataFrame:
    """The worksheet: whole rows once each, by matchup with nulls last, and two empty columns to fill in."""
    url = F.array_join("url", URL_MARK) if dict(battles.dtypes)["url"].startswith("array") else F.col("url")
    rows = battles.select("title", "matchup", url.alias("url"), "emcee1", "emcee2").distinct()
    rows = rows.withColumns({"winner": F.lit(""), "judging": F.lit("")})
    return rows.orderBy(F.asc_nulls_last("matchup"), "title", "url")


def latest(battles: DataFrame, n: int = 5) -> DataFrame:
    """The n latest uploads, ties by id."""
    return battles.orderBy(F.desc_nulls_last("upload_date"), "id").limit(n)
