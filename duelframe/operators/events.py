"""Transforms of the events table, and its join to the uploads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.functions import events as E
from duelframe.functions import patterns as P
from duelframe.operators.columns import hashable, unused

# Dates of uploads in this window, ends included, say nothing of the
# event's date; after the later day the description may.
WINDOW = ("2020-05-01 00:00:00", "2022-04-27 00:00:00")
DESCRIBED_AFTER = "2022-05-01 00:00:00"


def split_event_description(df: DataFrame, desc_col: str = "event_description") -> DataFrame:
    """event_date and event_location of the description."""
    if desc_col not in df.columns:
        return df
    text = F.col(desc_col).cast("string")
    return df.withColumns({"event_date": E.event_date(text), "event_location": E.split_location(text)})


def parse_event_date(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """The column as a timestamp without zone; null if it can't be read."""
    return df.withColumn(date_col, F.col(date_col).cast("string").try_cast("timestamp_ntz")) if date_col in df.columns else df


def clean_event_location(df: DataFrame, raw_loc_col: str = "event_location", new_col: str = "event_location_clean", league: str = P.LEAGUE) -> DataFrame:
    return df.withColumn(new_col, E.clean_location(F.col(raw_loc_col), league)) if raw_loc_col in df.columns else df


def extract_event_name(df: DataFrame, desc_col: str = "description", new_col: str = "event_name_from_desc", league: str = P.LEAGUE) -> DataFrame:
    return df.withColumn(new_col, E.event_name(F.col(desc_col), league)) if desc_col in df.columns else df


def fill_from_description(df: DataFrame, where=None, league: str = P.LEAGUE) -> DataFrame:
    """Fill null event_name, event_date and event_location_clean from description, in rows that where holds for."""
    if "description" not in df.columns:
        return df
    text = F.col("description")
    said = {
        "event_name": E.event_name(text, league),
        "event_date": E.event_date(text),
        "event_location_clean": E.clean_location(E.split_location(text), league),
    }
    now = {c: F.col(c) if c in df.columns else F.lit(None) for c in said}
    chosen = F.lit(True) if where is None else where
    return df.withColumns({c: F.when(chosen & now[c].isNull(), said[c]).otherwise(now[c]) for c in said})


#: Shares that rows without a key are dealt in, so that they don't meet in one task.
SALTS = 64


def first_of_each(df: DataFrame, key: str, cols: list[str], order_col: str | None = "_ord", nulls: bool = False) -> DataFrame:
    """key and cols of the first row for each key, by order_col, or by the columns if there is none; null is a key only with nulls."""
    order = F.col(order_col) if order_col in df.columns else F.struct(*cols)
    known = df if nulls else df.where(F.col(key).isNotNull())
    if not cols:
        return known.select(key).distinct()
    row = unused("row", df)
    first = known.groupBy(key).agg(F.min_by(F.struct(*cols), order).alias(row))
    return first.select(key, *[F.col(row)[c].alias(c) for c in cols])


def join_to_first(left: DataFrame, left_key: str, right: DataFrame, right_key: str, nulls: bool = False) -> DataFrame:
    """left with the columns of right, which has each key once, by a left join; its key is not among them.

    With nulls a null key meets the null key. Either way rows of left without a key are
    dealt in SALTS shares by hashes of what they hold, and a null key of right is in
    each share: so however many they are, they don't meet in one task, and left is
    computed once.
    """
    key, salt, own = unused("key", left, right), unused("salt", left, right), unused("own", left, right)
    shares = F.explode(F.when(F.col(right_key).isNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    once = right.withColumn(salt, shares if nulls else F.lit(0)).withColumnRenamed(right_key, key)
    dealt = left.withColumn(own, F.when(F.col(left_key).isNull(), F.pmod(F.xxhash64(*hashable(left)), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    same = F.col(left_key).eqNullSafe(F.col(key)) if nulls else F.col(left_key) == F.col(key)
    return dealt.join(once, same & (F.col(own) == F.col(salt)), "left").drop(own, salt, key)


def attach_event_metadata(uploads: DataFrame, events: DataFrame | None, league: str = P.LEAGUE, match_nulls: bool = False) -> DataFrame:
    """Left join of the events' name, date and place by video id, first event first, with the date's repairs.

    Without events, or without an id on either side, uploads stay as they are. The
    join's strategy is left to Spark, which broadcasts the events only while they
    are small. A row count never changes: events are one for each id. With match_nulls
    uploads without an id get the first event without one; else they get none.
    """
    if events is None or "id" not in uploads.columns:
        return uploads
    key = next((k for k in ("video_id", "id") if k in events.columns), None)
    if key is None:
        return uploads
    named, said = unused("event_key", uploads, events), unused("event_said", uploads, events)  # so that neither an upload's column of the key's name nor its own is meant
    # the joined rows are fewer than the events; without an order of their own, the events' dates and places are the order
    later = {"event_description", "_ord"} <= set(events.columns)
    tidy = events.withColumn(said, F.col("event_description").cast("string")) if later else events.transform(split_event_description).transform(clean_event_location, league=league)
    cols = [c for c in ("event_name", said) if c in tidy.columns] if later else [c for c in ("event_name", "event_date", "event_location_clean") if c in tidy.columns]
    met = lambda c: f"{c}_event" if c in uploads.columns else c
    first = first_of_each(tidy.withColumnRenamed(key, named), named, cols, nulls=match_nulls)
    out = join_to_first(uploads, "id", first.withColumnsRenamed({c: met(c) for c in cols}), named, match_nulls)
    if later:
        told = {"event_date": E.event_date(F.col(said)), "event_location_clean": E.clean_location(E.split_location(F.col(said)), league)}
        out = out.withColumns({met(c): x for c, x in told.items()}).drop(said)
    if not {"upload_date", "event_date"} <= set(out.columns):
        return out
    start, end, after = (F.lit(t).cast("timestamp_ntz") for t in (*WINDOW, DESCRIBED_AFTER))
    inside = F.col("upload_date").between(start, end)
    out = out.withColumn("event_date", F.when(inside, F.lit(None)).otherwise(F.col("event_date")))
    return fill_from_description(out, F.col("event_date").isNull() & F.coalesce(F.col("upload_date") > after, F.lit(False)), league)
