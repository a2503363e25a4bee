"""python -m duelframe uploads|events|battles|emcees ...; also a spark-submit entry. Errors end it with status 1 or 2."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from duelframe.functions.patterns import LEAGUE
from duelframe.operators.dims import build_emcees
from duelframe.plans.battles import build_battles, write_battles
from duelframe.sources import files, rest, web


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="duelframe", description="Tables of a battle league's videos.")
    sub = p.add_subparsers(dest="what", required=True)

    u = sub.add_parser("uploads", help="add a channel's new uploads to a JSON file")
    u.add_argument("--channel", required=True)
    u.add_argument("--output", default="data/raw/youtube_videos.json")
    u.add_argument("--secret", default="data/secret/secret.json")
    u.add_argument("--api", default=rest.API)
    u.add_argument("--checkpoint", help="folder of a stream's state: only pages down to the newest id of the last run are read")

    e = sub.add_parser("events", help="scrape the events of some years to CSV")
    e.add_argument("--start", type=int, required=True, help="first year")
    e.add_argument("--end", type=int, required=True, help="last year")
    e.add_argument("--base", required=True, help="the site's address")
    e.add_argument("--output", default="data/raw/matchup_events_metadata.csv")
    e.add_argument("--folder", help="folder that keeps the pages, so that a later run fetches only what is missing")
    e.add_argument("--rename-map", help="JSON object of aliases")
    e.add_argument("--user-agent", default=web.AGENT)
    e.add_argument("--sleep", type=float, default=0.6, help="seconds between pages")
    e.add_argument("--retries", type=int, default=2, help="tries after the first")
    e.add_argument("--request-sleep", type=float, default=0.7, help="seconds to wait longer after each failure")
    e.add_argument("--timeout", type=float, default=30)
    e.add_argument("--quiet", action="store_true")

    for name, text in (("battles", "build the battle table"), ("emcees", "build the emcee table")):
        b = sub.add_parser(name, help=text)
        b.add_argument("--raw", default="data/raw", help="folder of the raw files")
        b.add_argument("--output", required=True)
        b.add_argument("--league", default=LEAGUE, help="the league that titles name")
        b.add_argument("--rename-map", help="JSON object of aliases; the built-in ones without it")
        if name == "battles":
            b.add_argument("--format", default="csv", type=files.checked_format)
    return p


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    a = p.parse_args(args)
    if a.what == "events" and a.start > a.end:
        p.error("--start must not be after --end")
    spark = spark or SparkSession.builder.appName("duelframe").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        if a.what == "uploads" and a.checkpoint:
            rest.stream_channel_uploads(spark, a.channel, a.output, a.checkpoint, a.api, a.secret).awaitTermination()
            print(a.output)
        elif a.what == "uploads":
            print(f"{rest.fetch_channel_uploads(spark, a.channel, a.output, a.api, a.secret)} new uploads in {a.output}")
        elif a.what == "events":
            names = files.load_names(spark, a.rename_map)
            rows, failed = web.scrape_years(spark, a.start, a.end, a.base, names, a.folder, sleep=a.sleep, retries=a.retries, request_sleep=a.request_sleep, timeout=a.timeout, agent=a.user_agent)
            n = files.write_events(rows, a.output, files.is_one_file(a.output))
            for r in failed.toLocalIterator():
                print(f"failed: {r.url}: {r.error}", file=sys.stderr)
            if not a.quiet:
                print(f"{n} matchups in {a.output}")
        elif a.what == "battles":
            dated, undated = write_battles(spark, a.output, a.raw, a.format, names=files.load_names(spark, a.rename_map), league=a.league, one_file=files.is_one_file(a.output), counts=True)
            print(f"{dated + undated} battles in {a.output}, {undated} without a date")
        else:
            files.write_emcees(build_emcees(build_battles(spark, a.raw, names=files.load_names(spark, a.rename_map), league=a.league, ordered=False)), a.output, files.is_one_file(a.output))
            print(a.output)
    except (RuntimeError, ValueError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
