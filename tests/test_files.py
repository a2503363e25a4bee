"""Arrays read in ranges, and single files that are whole or not there."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from duelframe.operators.dims import build_emcees
from duelframe.sources import arrays, csvs, files, onefile


def array(rng, n):
    """A text of an array, and its objects: strings full of brackets, quotes and backslashes, and arrays within."""
    word = lambda: "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "a", "é", "\n", '\\"', " "]) for _ in range(rng.randint(0, 9)))
    rows = [{"id": f"{k}{word()}", word() + "k": [word(), {"x": [word()]}, []], "title": word()} for k in range(n)]
    between = rng.choice([",", ", ", ",\n  "])
    return ("[" + between.join(json.dumps(r, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 2])) for r in rows) + rng.choice(["]", "\n]\n"])).encode(), rows


def ranges(data, places):
    """Objects of data, read in ranges that begin at places, as the two passes do."""
    read = lambda at, n: data[at : at + n]
    cuts = [arrays.cut(read, p, len(data)) for p in [0, *places, len(data)]]
    inside, depth, out = False, 0, []
    for start, end in zip(cuts, cuts[1:]):
        out += [json.loads(x) for x in arrays.objects(read, start, end, inside, depth)]
        inside, by = arrays.after(data[start:end], inside)
        depth += by
    assert (inside, depth) == (False, 0)
    return out


def test_every_cut(monkeypatch):
    monkeypatch.setattr(arrays, "MORE", 3)
    rng = random.Random(5)
    for n in (0, 1, 2, 3):
        data, rows = array(rng, n)
        for p in range(len(data) + 1):
            assert ranges(data, [p]) == rows, (p, data)
    for _ in range(150):
        data, rows = array(rng, rng.randint(0, 6))
        places = sorted(rng.randrange(len(data)) for _ in range(rng.randint(0, 12)))
        assert ranges(data, places) == rows
    assert ranges(b'[1, "}{", [{"a": 1}], {"b": 2}, null]', [5, 9, 14]) == [{"b": 2}]  # other elements are passed over
    data = b'[{"a": "' + b"\\\\" * 50 + b'"}, {"b": "\\""}]'
    assert [ranges(data, [p]) for p in range(len(data))] == [[{"a": "\\" * 50}, {"b": '"'}]] * len(data)


def test_ranges_in_tasks(spark, tmp_path):
    rows = [{"id": str(k), "title": 'a "}],[{" \\ é', "tags": ["x", "]"]} for k in range(500)]
    (tmp_path / "a.json").write_text(json.dumps(rows, indent=2, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps(rows[:3]), encoding="utf-8")
    known = arrays.array_files(spark, f"{tmp_path}/*.json")
    got = arrays.array_elements(spark, known, 1000)
    assert got.rdd.getNumPartitions() > 20
    assert sorted((json.loads(r.value) for r in got.collect()), key=str) == sorted(rows + rows[:3], key=str)
    assert files.load_uploads(spark, f"{tmp_path}/a.json").where("title = 'a \"}],[{\" \\\\ é' and tags[1] = ']'").count() == 500
    for bad in ("[{]", '[{"id": "a"}', '[{"id": "a}]', "[}", ""):
        (tmp_path / "c.json").write_text(bad)
        assert files.load_existing(spark, f"{tmp_path}/c.json").count() == 0
        with pytest.raises(ValueError, match="no JSON array"):
            files.load_uploads(spark, f"{tmp_path}/c.json")
    (tmp_path / "c.json").write_text('[{"id": "a"}, {"id" "b"}, {"id": 7}]')
    assert sorted(r.id for r in files.load_existing(spark, f"{tmp_path}/c.json").collect()) == ["7", "a"]


def test_stores_that_tasks_cannot_open_are_read_whole(spark, tmp_path, monkeypatch):
    (tmp_path / "a.json").write_text('[{"id": "a"}, {"id": "b"}]')
    monkeypatch.setattr(files, "opens", lambda path: False)
    assert files.load_existing(spark, f"{tmp_path}/a.json").count() == files.load_uploads(spark, f"{tmp_path}/a.json").count() == 2


def test_the_old_file_outlives_failures(spark, tmp_path, monkeypatch):
    path = tmp_path / "up.json"
    files.save_uploads(spark.range(5).selectExpr("cast(id as string) as id"), str(path))
    old = path.read_bytes()
    with pytest.raises(Exception, match="(?i)divi"):
        files.save_uploads(spark.range(9, numPartitions=3).selectExpr("cast(1 / if(id = 8, 0, 1) as string) as id"), str(path))
    assert path.read_bytes() == old and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["up.json"]

    def crash(*_, **__):
        raise KeyboardInterrupt

    for step in ("swap", "string_together"):
        with monkeypatch.context() as m:
            m.setattr(onefile, step, crash)
            with pytest.raises(KeyboardInterrupt):
                files.save_uploads(spark.range(3).selectExpr("cast(id as string) as id"), str(path))
        assert path.read_bytes() == old and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["up.json"]
    files.save_uploads(files.load_existing(spark, str(path)).select("id").where("id > 2"), str(path))  # reads what it replaces
    assert sorted(r["id"] for r in json.loads(path.read_text())) == ["3", "4"] and files.load_existing(spark, str(path)).count() == 2


@pytest.mark.parametrize("mounted", [True, False])
def test_parts_in_their_places(spark, tmp_path, monkeypatch, mounted):
    """As a mounted file system takes them, and in a row by one task as others do."""
    monkeypatch.setattr(onefile, "is_mounted", lambda fs, path: mounted)
    df = spark.range(1000, numPartitions=7).selectExpr("id", "repeat('é', cast(id % 90 as int)) as t")
    files._write_csv(df, f"{tmp_path}/o.csv", True)
    with open(tmp_path / "o.csv", encoding="utf-8", newline="") as f:
        rows = list(csv.reader(f))
    assert rows == [["id", "t"]] + [[str(k), "é" * (k % 90)] for k in range(1000)]


def test_single_files_of_every_kind(spark, tmp_path):
    rows = [(["a", "b"], "T, \"q\"", "m", None, True), (["c"], "x\ny", None, "e", False)]
    df = spark.createDataFrame(rows, "id array<string>, title string, emcee1 string, emcee2 string, is_multipart boolean").coalesce(1)
    files.write_battles(df, f"{tmp_path}/b.csv", "csv", one_file=True)
    with open(tmp_path / "b.csv", encoding="utf-8", newline="") as f:
        assert list(csv.reader(f)) == [["id", "title", "emcee1", "emcee2"], ["['a', 'b']", 'T, "q"', "m", ""], ["c", "x\ny", "", "e"]]
    files.write_battles(df, f"{tmp_path}/b.json", "json", one_file=True)
    assert [json.loads(x) for x in (tmp_path / "b.json").read_text().splitlines()] == [{"id": ["a", "b"], "title": 'T, "q"', "emcee1": "m", "emcee2": None}, {"id": "c", "title": "x\ny", "emcee1": None, "emcee2": "e"}]
    files.write_emcees(build_emcees(df), f"{tmp_path}/e.csv", one_file=True)
    assert (tmp_path / "e.csv").read_text() == "emcee_id,emcee_name\n1,e\n2,m\n"
    files.write_emcees(build_emcees(df.limit(0)), f"{tmp_path}/e.csv", one_file=True)
    assert (tmp_path / "e.csv").read_text() == "emcee_id,emcee_name\n"
    events = df.select(F.lit("v").alias("video_id"), F.col("title").alias("matchup"), F.lit(1).alias("more"))
    assert files.write_events(events, f"{tmp_path}/v.csv", one_file=True) == 2 and files.write_events(events, f"{tmp_path}/v") == 2
    assert spark.read.csv(f"{tmp_path}/v.csv", header=True, multiLine=True, escape='"').columns == ["matchup", "video_id", "more"]


def test_csv_cut_anywhere(monkeypatch):
    """rows of ranges, wherever they are cut, are those of the whole."""
    monkeypatch.setattr(csvs, "MORE", 3)
    rng = random.Random(7)
    for _ in range(300):
        table = [["".join(rng.choice(['"', ",", "\n", "a", "é", " ", "\r"]) for _ in range(rng.randint(0, 5))) for _ in range(3)] for _ in range(rng.randint(1, 6))]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerows(table)
        data = out.getvalue().encode()[: None if rng.random() < 0.7 else -1]
        read = lambda at, n: data[at : at + max(0, n)]
        cuts = [csvs.cut(read, p, len(data)) for p in [0, *sorted(rng.randrange(len(data)) for _ in range(rng.randint(0, 9))), len(data)]]
        inside, got, places = False, [], []
        for start, end in zip(cuts, cuts[1:]):
            for place, row in csvs.rows(read, start, end, inside, len(data)):
                got += csv.reader(io.StringIO(row.decode(), newline=""))
                places.append(place)
            inside = csvs.ends(data[start:end], inside)
        assert got == list(csv.reader(io.StringIO(data.decode(), newline=""))) and places == sorted(set(places)), (data, cuts)


def test_one_large_csv_is_many_tasks(spark, tmp_path, monkeypatch):
    """values with line ends, quotes and commas don't leave a file to one task; rows and their order are Spark's."""
    text = "case id % 7 when 0 then null when 1 then '' when 2 then 'a,\"b\"\nc' when 3 then '\n\n\"' when 4 then ' é ' when 5 then 'NA' else 'x\r\ny' end"
    df = spark.range(900, numPartitions=3).selectExpr("cast(id as string) as matchup", f"{text} as event_name", "'d' as event_description", f"{text} as video_id")
    files._write_csv(df, f"{tmp_path}/o.csv", True)
    (tmp_path / "crlf.csv").write_bytes(b"\r\na b,c\r\n1,\r\n\r\n\"x\ny\",\"2\"\"\"\r\n\"p\r\nq\",7\r\n3\r\n4,5,6\r\nlast,8")
    (tmp_path / "open.csv").write_bytes(b"a,b\n1,\"2\n3,\"\"4\n5,6\n")
    for path in (f"{tmp_path}/o.csv", f"{tmp_path}/crlf.csv", f"{tmp_path}/open.csv"):
        whole = files.read_csv(spark, path)
        assert whole.rdd.getNumPartitions() == 1
        with monkeypatch.context() as m:
            m.setattr(files, "ONE_TASK", 10)
            m.setattr(csvs, "RANGE", 1000)
            got, events = files.read_csv(spark, path), files.load_event_metadata(spark, path)
        assert got.schema == whole.schema and sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))
        want = files.load_event_metadata(spark, path)
        assert events.orderBy("_ord").drop("_ord").collect() == want.orderBy("_ord").drop("_ord").collect()
        assert not path.endswith("o.csv") or got.rdd.getNumPartitions() > 5
