"""From uploads and events to one row for each battle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from duelframe.functions import patterns as P
from duelframe.operators import consolidate, events, uploads
from duelframe.operators.dims import ALIASES
from duelframe.sources import files

FINAL = ("id", "title", "description", "upload_date", "duration_seconds", "duration_hms", "emcee1", "emcee2", "matchup", "event_name", "event_date", "event_location", "url")
UNUSED = ("view_count", "likeCount", "commentCount", "tags", "matchup", "event_description", "video_id")

# Places that are written otherwise.
PLACE_FIXES = [(r"^Davao City,\s*Metro Manila,\s*Philippines$", "Davao City, Philippines"), (r"^Davao City$", "Davao City, Philippines")]


def make_uploads_1v1(raw: DataFrame, names: Mapping[str, str] | None = None, league: str = P.LEAGUE) -> DataFrame:
    """Clean one-on-one battle uploads with canonical names; without names the built-in aliases count, {} renames none.

    Titles decide which rows stay, so all else is read of those alone.
    """
    titled = raw.transform(uploads.clean_titles).transform(uploads.copy_title).transform(uploads.strip_part_suffix)
    return (
        titled.transform(uploads.keep_battles)
        .transform(uploads.parse_upload_date)
        .transform(uploads.add_duration_columns)
        .transform(uploads.convert_video_metrics_to_numeric)
        .transform(uploads.add_matchup_and_split, league=league)
        .transform(uploads.apply_emcee_rename, names=ALIASES if names is None else names)
        .transform(uploads.add_matchup_clean)
    )


def finalize_battles(df: DataFrame, ordered: bool = True, strict_schema: bool = False, flagged: bool = False) -> DataFrame:
    """The 13 columns, those there are or with strict_schema all, newest upload first and nulls last; flagged adds is_multipart."""
    out = df.drop(*UNUSED).withColumnsRenamed({"matchup_clean": "matchup", "event_location_clean": "event_location"})
    raw_place = "event_location" in df.columns and "event_location_clean" in df.columns
    if raw_place:
        out = df.drop(*UNUSED, "event_location").withColumnsRenamed({"matchup_clean": "matchup", "event_location_clean": "event_location"})
    out = consolidate.consolidate_parts(out)
    if "event_location" in out.columns:
        place = F.col("event_location")
        for pattern, by in PLACE_FIXES:
            place = F.regexp_replace(place, f"(?dU){pattern}", by)
        out = out.withColumn("event_location", place)
    if ordered and "upload_date" in out.columns:
        out = out.orderBy(F.desc_nulls_last("upload_date"), *[c for c in ("id",) if c in out.columns])
    flag = ["is_multipart"] * (flagged and "is_multipart" in out.columns)
    if strict_schema:
        kinds = {"upload_date": "timestamp_ntz", "event_date": "timestamp_ntz", "duration_seconds": "double", "id": "array<string>", "url": "array<string>"}
        return out.select(*[F.col(c) if c in out.columns else F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in FINAL], *flag)
    return out.select(*[c for c in FINAL if c in out.columns], *flag)


def battles(raw: DataFrame, event_rows: DataFrame | None, names: Mapping[str, str] | None = None, league: str = P.LEAGUE, **kw) -> DataFrame:
    """The battle table of the two raw tables."""
    return make_uploads_1v1(raw, names, league).transform(events.attach_event_metadata, events=event_rows, league=league).transform(finalize_battles, **kw)


def build_battles(spark: SparkSession, raw_dir: str, youtube_json_name: str = "youtube_videos.json", events_csv_name: str = "matchup_events_metadata.csv", names: Mapping[str, str] | None = None, league: str = P.LEAGUE, **kw) -> DataFrame:
    """The battle table of the two raw files; a file of no events counts as none."""
    event_rows = files.load_event_metadata(spark, f"{raw_dir}/{events_csv_name}")
    return battles(files.load_uploads(spark, f"{raw_dir}/{youtube_json_name}"), None if event_rows.isEmpty() else event_rows, names, league, **kw)


def write_battles(spark: SparkSession, out_path: str, raw_dir: str, fmt: str = "csv", one_file: bool = False, counts: bool = False, **kw) -> str | tuple[int, int]:
    """Build the battle table and write it as "csv" or "json"; the path, or with counts the numbers of battles with a date and without.

    The numbers are observed while the table is written.
    """
    kind, seen = files.checked_format(fmt), Observation()
    table = build_battles(spark, raw_dir, flagged=True, **kw)
    dated = F.count_if(F.col("event_date").isNotNull()) if "event_date" in table.columns else F.count_if(F.lit(False))
    files.write_battles(table.observe(seen, dated.alias("dated"), F.count(F.lit(1)).alias("all")), out_path, kind, one_file)
    return (seen.get["dated"], seen.get["all"] - seen.get["dated"]) if counts else out_path
