"""Files: JSON arrays, CSV and NDJSON."""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from duelframe.functions.patterns import NA_TOKENS
from duelframe.operators.incremental import append_new
from duelframe.sources import csvs
from duelframe.sources.arrays import array_elements, array_files, opens
from duelframe.sources.onefile import write_one
from duelframe.sources.sheet import write_sheet

UPLOADS = "id string, title string, description string, upload_date string, view_count string, duration string, url string, likeCount string, commentCount string, tags array<string>"
EVENTS = "matchup string, event_name string, event_description string, video_id string"
#: What stands between the rows of an array.
_BETWEEN = ",\n"
EVENT_COLUMNS = ("matchup", "event_name", "event_description", "video_id")


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if its files make fewer partitions; the raw rows move, before the work on them begins.

    A JSON array or a small file is one task otherwise. A large input has partitions enough and stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def load_uploads(spark: SparkSession, path: str) -> DataFrame:
    """The uploads of a JSON array, whose ranges all cores read, or of a folder of NDJSON."""
    if not is_array(path):
        return spread(spark.read.schema(UPLOADS).json(path))
    found = _array(spark, path)
    if found is None:
        raise ValueError(f"{path} holds no JSON array")
    return spread(found)


def _array(spark: SparkSession, path: str) -> DataFrame | None:
    """The objects of JSON arrays as uploads; None if there is no file, or one that is no array. Objects that aren't JSON inside are left out."""
    known = array_files(spark, path)
    if known and not all(opens(name) for name, _ in known[:1]):
        text = spark.read.text(path, wholetext=True)
        array = F.when(F.col("value").rlike(r"^\s*\["), F.col("value"))
        return text.select(F.from_json(array, f"array<struct<{_typed(UPLOADS)}>>").alias("a")).select(F.inline("a"))
    rows = array_elements(spark, known)
    if rows is None:
        return None
    read = rows.select(F.from_json("value", f"{UPLOADS}, not_json string", {"columnNameOfCorruptRecord": "not_json"}).alias("a")).select("a.*")
    return read.where("not_json is null").drop("not_json")


#: Bytes of a CSV file that one task reads; a larger one is read in ranges.
ONE_TASK = 128 << 20


def read_csv(spark: SparkSession, path: str, schema: str | None = None, order: str | None = None) -> DataFrame:
    """CSV of texts with a header, whose values may hold line ends; without a schema the header names them.

    order names a column to add, (file, row), in the rows' order. Spark gives each file
    to one task, so all cores read ranges if one is larger than ONE_TASK.
    """
    whole = spark.read.schema(schema) if schema else spark.read
    whole = whole.csv(path, header=True, multiLine=True, escape='"')
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row"))
    known = csvs.csv_files(spark, path)
    if any(size > ONE_TASK for _, size in known) and opens(known[0][0]):
        rows = csvs.csv_rows(spark, known)
        if rows is not None:
            read = F.from_csv("value", _texts(whole.columns), {"escape": '"'}).alias("r")
            return rows.select(read, F.struct("file", F.col("place").alias("row")).alias("o")).select("r.*", *([F.col("o").alias(order)] if order else []))
    return whole.withColumn(order, place) if order else whole


def _texts(columns: list[str]) -> str:
    return ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)


def load_event_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A CSV of events with a header, and _ord, the rows' order; tokens that mean "not available" are null."""
    rows = read_csv(spark, path, EVENTS, "_ord")
    clean = {c: F.when(F.col(c).isin(NA_TOKENS), None).otherwise(F.col(c)) for c in EVENT_COLUMNS}
    return rows.withColumns(clean)


def load_names(spark: SparkSession, path: str | None) -> dict[str, str] | None:
    """Aliases of a JSON object; None without a path, a ValueError for anything but an object."""
    if not path:
        return None
    said = json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))
    if not isinstance(said, Mapping):
        raise ValueError("the alias file must hold a JSON object")
    return dict(said)


def is_array(path: str) -> bool:
    """Whether path names a JSON array; any other name is a folder of NDJSON."""
    return path.endswith(".json")


def load_existing(spark: SparkSession, path: str) -> DataFrame:
    """The uploads saved so far; none if the path is missing, or a file that isn't a JSON array."""
    try:
        found = _array(spark, path) if is_array(path) else spark.read.schema(UPLOADS).json(path)
    except AnalysisException:
        found = None
    return spark.createDataFrame([], UPLOADS) if found is None else found


def _typed(schema: str) -> str:
    return ", ".join(f"{name}: {kind}" for name, kind in (c.strip().split(" ", 1) for c in schema.split(",")))


def save_uploads(df: DataFrame, path: str) -> None:
    """Replace path by a JSON array of df's rows, even if df reads path; until it is whole the old one stays.

    Tasks write the rows, each its own part, and string them together beside path.
    Adding a few rows to a large array writes all of it; a folder, which add_uploads
    makes longer, doesn't.
    """
    rows = df.select(F.concat(F.lit("  "), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).alias("value"))
    write_one(df.sparkSession, path, rows.write.option("lineSep", _BETWEEN).text, head=b"[\n", tail=b"\n]", trim=len(_BETWEEN))


def add_uploads(existing: DataFrame, fresh: DataFrame, path: str) -> None:
    """Add fresh rows to the uploads at path: parts of NDJSON to a folder, without touching what is there; an array is written anew."""
    if is_array(path):
        save_uploads(append_new(existing, fresh), path)
    else:
        fresh.write.mode("append").json(path, ignoreNullFields=False)


def checked_format(fmt: str) -> str:
    kind = fmt.lower()
    if kind not in ("csv", "json"):
        raise ValueError(f"unsupported format: {fmt!r}; choose 'csv' or 'json'")
    return kind


def _alone(df: DataFrame, c: str) -> Column:
    """Whether a list is written as its one element: by the flag is_multipart, or without it by size."""
    return ~F.col("is_multipart") if "is_multipart" in df.columns else F.size(c) == 1


def _listed(df: DataFrame, c: str) -> Column:
    """A list as text: a lone element as it is, others in the notation ['a', 'b']."""
    quoted = F.transform(c, lambda x: F.coalesce(F.concat(F.lit("'"), x, F.lit("'")), F.lit("None")))
    return F.when(_alone(df, c), F.get(c, F.lit(0))).otherwise(F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def _write_csv(df: DataFrame, path: str, one_file: bool, **options) -> None:
    """A folder of CSV files, each with the header, or one file in the order of df's partitions."""
    options = {"escape": '"'} | options
    if not one_file:
        df.write.mode("overwrite").options(**options).csv(path, header=True)
        return
    head = io.StringIO()
    csv.writer(head, lineterminator="\n").writerow(df.columns)
    write_one(df.sparkSession, path, df.write.options(**options).csv, head=head.getvalue().encode())


def is_one_file(path: str) -> bool:
    """Whether a name has the ending of a file; commands then write one."""
    return path.endswith((".csv", ".json", ".ndjson"))


def write_battles(df: DataFrame, path: str, fmt: str = "csv", one_file: bool = False) -> None:
    """A folder of CSV files with a header, or of NDJSON with times in milliseconds since 1970 and lists as lists; or one file.

    Ids and urls of battles in parts are lists, others single values; is_multipart
    tells which, if df has it, and isn't written.
    """
    kind = checked_format(fmt)
    arrays = [c for c, k in df.dtypes if k.startswith("array")]
    if kind == "csv":
        out = df.withColumns({c: _listed(df, c) for c in arrays}).drop("is_multipart")
        _write_csv(out, path, one_file, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
        return
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    times = {c: F.timestamp_diff("MILLISECOND", epoch, F.col(c)) for c, k in df.dtypes if k == "timestamp_ntz"}
    lists = {c: F.when(_alone(df, c), F.get(c, F.lit(0)).cast("variant")).otherwise(F.to_variant_object(c)) for c in arrays}
    out = df.withColumns(times | lists).drop("is_multipart").write.option("ignoreNullFields", False)
    if one_file:
        write_one(df.sparkSession, path, out.json)
    else:
        out.mode("overwrite").json(path)


def write_emcees(emcees: DataFrame, path: str, one_file: bool = False) -> None:
    _write_csv(emcees, path, one_file)


def write_events(df: DataFrame, path: str, one_file: bool = False) -> int:
    """The known columns first, then any others; the number of rows, counted as they are written."""
    known = [c for c in EVENT_COLUMNS if c in df.columns]
    seen = Observation()
    _write_csv(df.select(*known, *[c for c in df.columns if c not in known]).observe(seen, F.count(F.lit(1)).alias("rows")), path, one_file)
    return seen.get["rows"]


def write_review(df: DataFrame, path: str) -> None:
    """The worksheet for people to fill in: a workbook if path ends in .xlsx, else a folder with one CSV file."""
    if path.endswith(".xlsx"):
        write_sheet(df, path)
    else:
        df.coalesce(1).write.mode("overwrite").csv(path, header=True, escape='"')
