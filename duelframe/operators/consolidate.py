"""Uploads in parts, put together to a battle each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelframe.functions import times, titles
from duelframe.operators.columns import hashable, unused

LISTED = ("id", "url")
FIRST = ("description", "title", "yt_raw_title", "emcee1", "emcee2", "matchup", "event_name", "event_date", "event_location")


def consolidate_parts(df: DataFrame) -> DataFrame:
    """One row for all parts of a title; other rows as they are.

    id and url become arrays, of one element for a row that is no part, and
    is_multipart tells the two apart. Of the parts, in the order of their numbers,
    ids and urls are listed, the earliest upload date and the sum of durations are
    taken (0 if all are null), and of every other column the first value that isn't
    null. duration_hms is derived again for all rows. Columns that the groups don't
    have become null in them.

    Everything is one aggregation, so df is computed once: parts meet by their title,
    and any other row is a group of its own, by hashes of all it holds. Rows that are
    equal in everything are counted and come back as often. Groups sum up before the
    shuffle; no order of rows is relied on. What only parts need (their order, their
    lists) is null for the other rows, so these pass the shuffle once each, as they are.
    """
    if "yt_raw_title" not in df.columns:
        return df
    if "duration_seconds" in df.columns:
        df = df.withColumn("duration_seconds", F.col("duration_seconds").cast("double"))
    base, one, two, order, copies, copy = (unused(c, df) for c in ("base", "one", "two", "order", "copies", "copy"))
    raw, part = F.col("yt_raw_title"), titles.is_part(F.col("yt_raw_title"))
    listed = [c for c in LISTED if c in df.columns]
    hashes = [F.when(~part, F.xxhash64(*hashable(df), F.lit(k))) for k in (1, 2)]
    keyed = df.withColumns({
        base: F.when(part, F.coalesce(titles.base_title(raw), F.lit(""))),
        one: hashes[0],
        two: hashes[1],
        order: F.when(part, F.struct(titles.part_number(raw).alias("n"), raw.alias("t"), *[F.col(c).alias(f"k_{c}") for c in listed])),
    })
    multi = F.col(base).isNotNull()

    def alone(c: str) -> Column:
        return F.first(F.when(F.col(base).isNull(), F.col(c)))

    def first(c: str) -> Column:
        return F.min_by(F.when(multi, F.col(c)), F.when(F.col(c).isNotNull(), F.col(order)))

    # the order's own columns are the lists: one list for all
    every = F.array_sort(F.collect_list(order))

    def in_order(c: str) -> Column:
        return F.when(multi, F.transform(every, lambda x: x[f"k_{c}"])).otherwise(F.array(alone(c)))

    said = {c: in_order(c) for c in listed}
    said |= {c: F.when(multi, first(c)).otherwise(alone(c)) for c in FIRST}
    said["upload_date"] = F.min("upload_date")
    said["duration_seconds"] = F.when(multi, F.coalesce(F.sum("duration_seconds"), F.lit(0.0))).otherwise(F.min("duration_seconds"))
    aggs = [said.get(c, alone(c)).alias(c) for c in df.columns if c != "is_multipart"]
    out = keyed.groupBy(base, one, two).agg(*aggs, F.when(multi, 1).otherwise(F.count("*").cast("int")).alias(copies))
    out = out.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies)))).withColumn("is_multipart", multi)
    if "title" in df.columns:
        out = out.withColumn("title", F.when(multi, F.coalesce("title", base)).otherwise(F.col("title")))
    else:
        out = out.withColumn("title", F.col(base))
    out = out.drop(base, one, two, copies, copy)
    return out.withColumn("duration_hms", times.clock(F.col("duration_seconds"))) if "duration_seconds" in df.columns else out
