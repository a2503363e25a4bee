"""Transforms of the uploads table. A missing column makes a transform do nothing."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions import patterns as P
from duelframe.functions import times, titles
from duelframe.functions.text import strip
from duelframe.operators.columns import unused, where_put
from duelframe.sources.staging import staged


def clean_titles(df: DataFrame, title_col: str = "title") -> DataFrame:
    return df.withColumn(title_col, titles.clean_title(F.col(title_col))) if title_col in df.columns else df


def parse_upload_date(df: DataFrame, upload_date_col: str = "upload_date", new_col: str = "upload_date", format_by: str | None = None) -> DataFrame:
    """Times without zone, in UTC; null if they can't be read.

    Each text is read by itself. With format_by, a column that orders the rows, the first
    text that can be read sets the format, and texts of another one become null.
    """
    if upload_date_col not in df.columns:
        return df
    said, read = F.col(upload_date_col), times.utc_timestamp(F.col(upload_date_col))
    if format_by is not None:
        first = df.where(read.isNotNull()).select(F.min_by(times.format_of(said), F.col(format_by))).scalar()
        read = F.when(times.format_of(said) == first, read)
    return df.withColumn(new_col, read)


def add_duration_columns(df: DataFrame, duration_col: str = "duration") -> DataFrame:
    if duration_col not in df.columns:
        return df
    seconds = times.duration_seconds(F.col(duration_col).cast("string"))
    # one after the other: at once, the clock would compute the seconds anew for each of its parts
    return df.withColumn("duration_seconds", seconds).withColumn("duration_hms", times.clock(F.col("duration_seconds")))


def convert_video_metrics_to_numeric(df: DataFrame, cols: Iterable[str] = ("view_count", "likeCount", "commentCount")) -> DataFrame:
    """As doubles; what is no number becomes null."""
    return df.withColumns({c: F.col(c).cast("string").try_cast("double") for c in cols if c in df.columns})


def copy_title(df: DataFrame) -> DataFrame:
    """Keep the cleaned title, with its part number, as yt_raw_title."""
    return df.withColumn("yt_raw_title", F.col("title")) if "title" in df.columns else df


def strip_part_suffix(df: DataFrame) -> DataFrame:
    return df.withColumn("title", titles.base_title(F.col("title"))) if "title" in df.columns else df


def filter_titles_with_vs(df: DataFrame) -> DataFrame:
    return df.where(titles.names_versus(F.col("title"))) if "title" in df.columns else df


def drop_non_battles(df: DataFrame) -> DataFrame:
    return df.where(~titles.is_excluded(F.col("title"))) if "title" in df.columns else df


def keep_one_on_one(df: DataFrame) -> DataFrame:
    return df.where(titles.is_one_on_one(F.col("title"))) if "title" in df.columns else df


def keep_battles(df: DataFrame) -> DataFrame:
    """filter_titles_with_vs, drop_non_battles and keep_one_on_one at once."""
    return where_put(df, titles.is_battle(F.col("title"))) if "title" in df.columns else df


def add_matchup_and_split(df: DataFrame, league: str = P.LEAGUE) -> DataFrame:
    """matchup, emcee1 and emcee2 of the title; null where it names no two."""
    if "title" not in df.columns:
        return df
    out = df.withColumn("matchup", titles.without_annotation(titles.matchup(F.col("title"), league)))
    return out.withColumns({"emcee1": titles.side(F.col("matchup"), 0), "emcee2": titles.side(F.col("matchup"), 1)})


#: Aliases that every task may be given as a table, about 20 MB.
MOST_ALIASES = 1 << 18


def apply_emcee_rename(df: DataFrame, names: Mapping[str, str] | DataFrame | None = None) -> DataFrame:
    """Canonical names of both sides; a map is part of the plan, a table (alias, name) is joined and may have any size.

    A table's aliases are stripped and compared as a map's; nulls are void, and of
    several names for an alias the least counts. It is broadcast if it is small, and
    otherwise only what the sides' distinct names meet of it takes part, so a name that
    most rows have is joined once.
    """
    if names is None or not {"emcee1", "emcee2"} <= set(df.columns):
        return df
    if isinstance(names, Mapping):
        return df.withColumns({c: titles.canonical(F.col(c), names) for c in ("emcee1", "emcee2")})
    alias, name = unused("alias", df), unused("name", df)
    known = names.select(strip(F.col("alias")).alias(alias), F.col("name").alias(name)).where(F.col(alias).isNotNull() & F.col(name).isNotNull())
    known = known.groupBy(alias).agg(F.min(name).alias(name))
    out = df.withColumns({c: strip(F.col(c).cast("string")) for c in ("emcee1", "emcee2")})
    if names.count() > MOST_ALIASES:
        said = out.select(F.explode(F.array("emcee1", "emcee2")).alias(alias)).distinct()
        known = staged(known.join(said, alias))
        small = known.count() <= MOST_ALIASES
    else:
        small = True
    known = F.broadcast(known) if small else known
    for c in ("emcee1", "emcee2"):
        out = out.join(known, F.col(c) == F.col(alias), "left").withColumn(c, F.coalesce(name, c)).drop(alias, name)
    return out


def add_matchup_clean(df: DataFrame) -> DataFrame:
    """"A vs B" of the canonical names; null if one is."""
    if not {"emcee1", "emcee2"} <= set(df.columns):
        return df
    return df.withColumn("matchup_clean", F.concat(strip(F.col("emcee1")), F.lit(" vs "), strip(F.col("emcee2"))))
