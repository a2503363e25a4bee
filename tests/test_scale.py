"""Plans and tables of a size or skew that samples don't have: one read of the uploads, null keys, alias tables, helper names."""

import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from duelframe.operators import consolidate, dims, events, uploads
from duelframe.plans import battles as B
from duelframe.sources import files, staging

EVENT = "matchup string, event_name string, event_description string, video_id string, _ord int"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def raw(spark, tmp_path):
    rows = [(f"v{k}", f"Bar League - A{k % 9} vs B{k % 7}" + (" pt. 1" if k % 3 else ""), "d", "2019-01-01T00:00:00Z", None, "PT1S", f"u{k}", None, None, []) for k in range(60)]
    spark.createDataFrame(rows, files.UPLOADS).repartition(6).write.parquet(f"{tmp_path}/up")
    spark.createDataFrame([("m", "E", "x", f"v{k}", k) for k in range(0, 60, 4)], EVENT).write.parquet(f"{tmp_path}/ev")
    return spark.read.parquet(f"{tmp_path}/up"), spark.read.parquet(f"{tmp_path}/ev")


def test_uploads_are_read_once(spark, raw, monkeypatch):
    up, ev = raw
    whole = B.battles(up, ev)
    assert plan(whole).count("FileScan") == 2 and plan(whole).count("/up]") == 1
    kept = []
    monkeypatch.setattr(dims, "staged", lambda df: kept.append(df) or staging.staged(df))
    got = dims.build_emcees(B.battles(up, ev, ordered=False))
    assert plan(kept[0]).count("/up]") == 1 and plan(kept[0]).count("FileScan") == 2  # what the names come from
    assert "/up]" not in plan(got)  # and their numbers come from the written names alone
    assert [r.emcee_name for r in got.collect()] == sorted({f"A{k}" for k in range(9)} | {f"B{k}" for k in range(7)})


def test_names_in_many_ranges(spark):
    names = [f"{'same beginning' * (k % 2)}{k:05d}" for k in range(3000)]
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    got = dims.dense_ids(frame.withColumnRenamed("name", "range"), "range", "n").collect()
    assert sorted((r.n, r.range) for r in got) == list(enumerate(sorted(names), 1))
    assert dims.dense_ids(frame.limit(0), "name").count() == 0


def test_equal_rows_that_are_no_parts_stay_as_often_as_they_are(spark):
    rows = [("a", "A vs B", 1.0, {"k": 1})] * 3 + [(None, "A vs B", 1.0, None)] * 2 + [("p", "C vs D pt. 1", 1.0, None), ("p", "C vs D pt. 1", 1.0, None)]
    df = spark.createDataFrame(rows, "id string, yt_raw_title string, duration_seconds double, base map<string,int>")
    got = consolidate.consolidate_parts(df.withColumn("base", F.col("id"))).collect()
    assert sorted((str(r.id), r.duration_seconds, str(r.base)) for r in got) == sorted([("['a']", 1.0, "a")] * 3 + [("[None]", 1.0, "None")] * 2 + [("['p', 'p']", 2.0, "None")])
    assert sorted(str(r.base) for r in consolidate.consolidate_parts(df).collect()) == ["None"] * 3 + ["{'k': 1}"] * 3


def test_helper_columns_never_clash(spark):
    names = ["key", "salt", "own", "row", "event_key", "base", "one", "two", "order", "copies", "copy", "alias", "name", "_key", "_row", "at", "range", "size", "before"]
    up = spark.createDataFrame([("a", "Bar League - X vs Y pt. 1", *names)], "id string, title string, " + ", ".join(f"{n} string" for n in names))
    ev = spark.createDataFrame([("m", "E", "x. Jan 1, 2020", "a", 1, "r", "k")], f"{EVENT}, row string, key string")
    got = events.attach_event_metadata(up, ev)
    assert got.first().asDict() | {n: n for n in names} == got.first().asDict() and got.first().event_name == "E"
    for table in (dims.ALIASES, spark.createDataFrame([("X", "Z")], "alias string, name string")):
        named = got.transform(uploads.copy_title).transform(uploads.add_matchup_and_split).transform(uploads.apply_emcee_rename, names=table)
        assert [c for c in names if c not in named.columns] == []
    assert named.first().emcee1 == "Z"
    assert consolidate.consolidate_parts(named).count() == 1
    assert dims.dense_ids(up, "range", "at").first() == (1, "range")


def test_null_ids_meet_only_if_asked_to_and_never_in_one_task(spark):
    up = spark.range(4000).selectExpr("case when id % 4 = 0 then concat('v', id) end as id", "cast(id as string) as title")
    ev = spark.createDataFrame([("m", "none, later", "x", None, 2), ("m", "none", "x", None, 1), ("m", "four", "x", "v4", 3)], EVENT)
    for nulls, met in ((False, 0), (True, 3000)):
        got = events.attach_event_metadata(up, ev, match_nulls=nulls)
        assert got.count() == 4000 and got.where("event_name = 'none'").count() == met
        assert [r.id for r in got.where("event_name = 'four'").collect()] == ["v4"]
    given = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in given}
    for k, v in given.items():
        spark.conf.set(k, v)
    try:
        got = events.attach_event_metadata(up, ev, match_nulls=True)
        assert "SortMergeJoin" in plan(got)
        tasks = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert sum(r["count"] for r in tasks) == 4000 and max(r["count"] for r in tasks) < 2000
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_a_million_aliases_make_no_longer_plan(spark, monkeypatch):
    names = spark.range(1_000_000).selectExpr("concat(' N', id, ' ') as alias", "concat('M', id) as name")
    few = spark.createDataFrame([("A", "B"), ("A", "Aa"), (None, "x"), ("C", None), ("B", "C")], "alias string, name string")
    df = spark.createDataFrame([("N7", " N999999 "), ("N1000000", None), ("A", "B"), ("C", "x")], "emcee1 string, emcee2 string")
    got = uploads.apply_emcee_rename(df, names)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("M7", "M999999"), ("N1000000", None), ("A", "B"), ("C", "x")], key=str)
    assert len(plan(got)) < 20_000
    mapped = uploads.apply_emcee_rename(df, {"A": "Aa", "B": "C"})
    for most in (uploads.MOST_ALIASES, 0):  # broadcast, or joined with the names that there are
        monkeypatch.setattr(uploads, "MOST_ALIASES", most)
        assert sorted(map(tuple, uploads.apply_emcee_rename(df, few).collect()), key=str) == sorted(map(tuple, mapped.collect()), key=str)


def test_one_format_or_each_by_itself(spark):
    texts = [None, "soon", "2020-01-02T03:04:05Z", "2020-01-02T03:04:05.5Z", "2020-01-02", "2020-01-02T03:04:05+01:00"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, upload_date string")
    read = lambda **kw: [str(r.upload_date) for r in uploads.parse_upload_date(df, **kw).orderBy("n").collect()]
    assert read() == ["None", "None", "2020-01-02 03:04:05", "2020-01-02 03:04:05.500000", "2020-01-02 00:00:00", "2020-01-02 02:04:05"]
    assert read(format_by="n") == ["None", "None", "2020-01-02 03:04:05", "None", "None", "2020-01-02 02:04:05"]
    assert uploads.parse_upload_date(df.where("n < 2"), format_by="n").where("upload_date is not null").count() == 0


def test_nothing_stays_in_the_shared_folder(tmp_path):
    """Neither after stop() nor if the program just ends; Spark's own folder for checkpoints is its own affair."""
    code = f"""
import os, sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession
from duelframe.operators.dims import dense_ids
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path)!r}).getOrCreate()
ours = lambda: [x for x in os.listdir({str(tmp_path)!r}) if x.startswith("duelframe")]
assert dense_ids(spark.createDataFrame([("b",), ("a",)], "name string")).count() == 2
assert len(ours()) == 1
if sys.argv[1] == "stop":
    spark.stop()
    assert ours() == []
"""
    for how in ("stop", "leave"):
        said = subprocess.run([sys.executable, "-c", code, how], capture_output=True, text=True, cwd=tmp_path.parent)
        assert said.returncode == 0, said.stderr[-2000:]
        for _ in range(50):
            left = [x for x in os.listdir(tmp_path) if x.startswith("duelframe")]
            if not left:
                break
            time.sleep(0.2)
        assert left == []
