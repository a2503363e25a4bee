from datetime import datetime

import pytest
from pyspark.sql import functions as F

from duelframe.functions import events, text, times, titles


def check(spark, fn, pairs, kind="string"):
    frame = spark.createDataFrame([(k, x) for k, (x, _) in enumerate(pairs)], f"k int, x {kind}")
    got = {r.k: r.y for r in frame.select("k", fn(F.col("x")).alias("y")).collect()}
    for k, (x, want) in enumerate(pairs):
        assert got[k] == (pytest.approx(want) if isinstance(want, float) else want), (x, got[k], want)


def test_strip_and_clean(spark):
    check(spark, text.strip, [("  a b \n", "a b"), ("\x1c\x1fa\t", "a"), (" ", ""), (None, None), ("é", "é")])
    check(spark, titles.clean_title, [('  "A vs B pt. 1 " ', "A vs B pt. 1 "), ('"A" vs "B"', 'A" vs "B'), ('"', '"'), ('""', ""), (None, None)])
    check(spark, text.non_empty, [("", None), (" ", " "), (None, None)])


def test_parts(spark):
    check(spark, titles.base_title, [
        ("L - Dello vs Batas pt. 1", "L - Dello vs Batas"), ("A vs B PT 12", "A vs B"), ("A vs Egypt 2", "A vs Egy"), ("A vs B pt. 1 ", "A vs B"), ("A vs B part 1", "A vs B part 1"), (None, None),
    ])
    check(spark, titles.part_number, [("A pt. 3", 3), ("A pt3", 3), ("A pt. 3 ", None), ("A", None), (None, None), ("Egypt 2", 2)])
    check(spark, titles.is_part, [("A pt. 3", True), ("A vs B pt. 1 ", False), (None, False)])


def test_matchups(spark):
    check(spark, lambda c: titles.without_annotation(titles.matchup(c)), [
        ("Bar League - Dello vs Batas", "Dello vs Batas"), ("Bar League – A vs B", "A vs B"), ("BAR LEAGUE Fest - A VS B @ Ahon", "A vs B"),
        ("Bar League - M-Zhayt vs X", "M-Zhayt vs X"), ("Bar League - A vs B - Finals", "A vs B"), ("Bar League - A vs. B", None),
        ("Bar League A vs M-Zhayt", None), ("Bar League - X vs No. 144", "X vs No."), ("A vs Poison 13", "A vs Poison"), ("Poison 13 vs A", "Poison 13 vs A"),
        ("Day 2 - A vs B", "Day 2"), ("A vs B | tag", "A vs B"), ("A vs B (x) 2", "A vs B"), ("A vs *", None), (" vs B", None), ("A vs B vs C", "A vs B vs C"), (None, None), ("", None),
    ])
    check(spark, lambda c: titles.side(c, 1), [("A vs B", "B"), ("Day 2", None), ("A vs B vs C", "B vs C"), (None, None)])
    check(spark, lambda c: titles.canonical(c, {"a": "b", "b": "c"}), [(" a ", "b"), ("A", "A"), ("b", "c"), (None, None)])
    check(spark, lambda c: titles.canonical_any_case(c, {"Ab": "x", "aB": "y"}), [(" AB", "y"), ("c", "c"), (None, "")])
    check(spark, lambda c: titles.canonical_any_case(c, {}), [(" AB", "AB")])


def test_filters(spark):
    rows = [
        ("A vs B", True), ("Vlog 12", False), ("Preview: A vs B", False), ("[LIVE] A vs B", False), ("A vs B vs C", False), ("A and B vs C", True), ("A and B vs C and D", False),
        ("A/B vs C", False), ("A + B vs C", False), ("5 on 5: A vs B", False), ("5on5 A vs B", False), (None, False), ("A vs. B", True), ("Avs B", False), ("A vs\nB", True), ("A vs B promoter", False), ("Andy vs Sandy", True), ("A VS B", True),
    ]
    check(spark, titles.is_battle, rows)
    check(spark, lambda c: titles.names_versus(c) & ~titles.is_excluded(c) & titles.is_one_on_one(c), rows)
    check(spark, titles.is_excluded, [(None, False), ("Beat Box", True), ("live", False)])


def test_times(spark):
    pairs = [("PT12M34S", 754.0), ("P1DT1H1M1S", 90061.0), ("P0D", 0.0), ("PT1,5S", 1.5), ("P1W", 604800.0), ("-PT5S", -5.0), ("P0Y0M1D", 86400.0)] + [(x, None) for x in ("bad", "", None, "P1M", "P1Y", "P", "PT", "PT1H2", "T1H")]
    check(spark, times.duration_seconds, pairs)
    check(spark, times.clock, [(754.0, "00:12:34"), (90061.0, "01:01:01"), (1.5, "00:00:01"), (0.0, "00:00:00"), (86399.9, "23:59:59"), (-5.0, "23:59:55"), (None, None)], "double")
    stamps = [("2026-02-19T12:40:15Z", datetime(2026, 2, 19, 12, 40, 15)), ("2026-02-19", datetime(2026, 2, 19)), ("2026-02-19T12:40:15+08:00", datetime(2026, 2, 19, 4, 40, 15)), ("2026-02-19 12:40:15.5", datetime(2026, 2, 19, 12, 40, 15, 500000)), ("bad", None), ("", None), (None, None)]
    check(spark, times.utc_timestamp, stamps)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Manila")
    try:
        check(spark, lambda c: times.utc_timestamp(c).cast("string"), [("2026-02-19T12:40:15Z", "2026-02-19 12:40:15"), ("2026-02-19", "2026-02-19 00:00:00"), ("2026-02-19 01:00:00", "2026-02-19 01:00:00")])
        check(spark, times.clock, [(754.0, "00:12:34")], "double")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_event_descriptions(spark):
    rows = [
        ("Bar League presents: Ahon 12 @ B-Side, Makati City. Dec. 20-21, 2024", "2024-12-20", "Ahon 12 @ B-Side, Makati City", "B-Side, Makati City", "Ahon 12"),
        ("Bar League presents: Gubat 12, Day 1 @ Cebu City. Sept. 5, 2015", "2015-09-05", "Gubat 12, Day 1 @ Cebu City", "Cebu City", "Gubat 12, Day 1"),
        ("Sep. 5, 2015", None, "Sep. 5, 2015", "5, 2015", None),
        ("Some event. Quezon City", None, "Some event. Quezon City", "Quezon City", None),
        ("Some event. Quezon City.", None, "Some event. Quezon City.", None, None),
        ("Feb. 31, 2010", None, None, None, None),
        ("Feb 6 2010", None, "Feb 6 2010", "Feb 6 2010", None),
        ("", None, None, None, None), ("  ", None, None, None, None), (None, None, None, None, None),
        ("Lamar 5, 2010", "2010-03-05", "La", "La", None), ("X. Dec. 31 - Jan. 1, 2011", "2011-01-01", "X. Dec. 31 -", "31", None),
        ("At: Manila . MAY 1, 2019 and Jun 2, 2020", "2019-05-01", "Manila", "Manila", None), ("May 0, 2010", None, None, None, None),
        ("bar league\n presents Ahon -  @ x @ Bar League: Davao,", None, "bar league\n presents Ahon -  @ x @ Bar League: Davao,", "Davao", "Ahon"),
    ]
    check(spark, lambda c: events.event_date(c).cast("date").cast("string"), [(r[0], r[1]) for r in rows])
    check(spark, events.split_location, [(r[0], r[2]) for r in rows])
    check(spark, lambda c: events.clean_location(events.split_location(c)), [(r[0], r[3]) for r in rows])
    check(spark, events.event_name, [(r[0], r[4]) for r in rows])
    check(spark, lambda c: events.event_name(c, "Other"), [("Other presents x @ y", "x")])
