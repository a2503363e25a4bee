"""Pages fetched once each, whatever is lost on the way.

A crawl has a folder that all nodes share. A task that has fetched a page puts it there
before it goes on, so a task that runs again, on another executor or in a later run,
finds what is done and asks for no page twice. The addresses, what is in the folder
about them, and what is left to do are tables.
"""

from __future__ import annotations

import hashlib
import json
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone

import pandas as pd
from pyarrow import fs as arrow
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.sources.staging import hadoop

AGENT = "Mozilla/5.0 (compatible; battle catalogue)"
#: What is kept of a page; html or error is null.
RECORD = "url string, html string, error string, tries int, run string, fetched_at timestamp"


def get_page(url: str, retries: int = 2, sleep: float = 0.7, timeout: float = 30, agent: str = AGENT) -> str:
    """A page's text; after each failure it waits sleep seconds longer, and after the last it raises."""
    last: object = None
    for k in range(retries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent}), timeout=timeout) as answer:
                return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")
        except (urllib.error.URLError, TimeoutError, ValueError) as e:
            last = getattr(e, "code", None) or getattr(e, "reason", None) or e
            time.sleep(sleep * (k + 1))
    raise RuntimeError(f"{url} can't be fetched: {last}")


class Shelf:
    """The pages of a crawl's folder, as a task sees them: a file each, named by a hash of its address."""

    def __init__(self, folder: str):
        self.store, self.root = arrow.FileSystem.from_uri(folder)

    def _name(self, url: str) -> tuple[str, str]:
        key = hashlib.sha256(url.encode()).hexdigest()
        return f"{self.root}/pages/{key[:2]}", f"{key}.json"

    def get(self, url: str) -> dict | None:
        try:
            with self.store.open_input_stream("/".join(self._name(url))) as f:
                return json.loads(f.read())
        except FileNotFoundError:
            return None

    def put(self, record: dict) -> None:
        """Written under another name first: a file under its own name is whole."""
        folder, name = self._name(record["url"])
        self.store.create_dir(folder, recursive=True)
        draft = f"{folder}/_{uuid.uuid4().hex}"
        with self.store.open_output_stream(draft) as f:
            f.write(json.dumps(record).encode())
        self.store.move(draft, f"{folder}/{name}")


def _address(spark: SparkSession, folder: str) -> str:
    fs, at = hadoop(spark, folder)
    fs.mkdirs(at)
    uri = fs.makeQualified(at).toUri()
    return f"{uri.getScheme()}://{uri.getAuthority() or ''}{uri.getPath()}"


def shelved(spark: SparkSession, folder: str) -> DataFrame:
    """RECORD of all pages in a crawl's folder."""
    try:
        return spark.read.schema(RECORD).json(f"{folder.rstrip('/')}/pages/*/")
    except AnalysisException:
        return spark.createDataFrame([], RECORD)


def frontier(urls: DataFrame, folder: str) -> DataFrame:
    """(url, state, tries, fetched_at) of the addresses, once each: state is done, failed (and tried again next time) or todo."""
    known = shelved(urls.sparkSession, folder).select("url", "error", "tries", "fetched_at")
    state = F.when(F.col("fetched_at").isNull(), "todo").when(F.col("error").isNotNull(), "failed").otherwise("done")
    return urls.select("url").where("url is not null").distinct().join(known, "url", "left").select("url", state.alias("state"), F.coalesce("tries", F.lit(0)).alias("tries"), "fetched_at")


def crawl(urls: DataFrame, folder: str, sleep: float = 0.6, retries: int = 2, request_sleep: float = 0.7, timeout: float = 30, agent: str = AGENT, tasks: int = 1, fetch: Callable[[str], str] | None = None) -> DataFrame:
    """(url, html, error) of the addresses, once each, fetching those that the folder doesn't hold.

    A host's addresses are shared by `tasks` claims, each a task's; together they ask it
    for a page every sleep seconds at most. A page that fails is kept with its error, and
    tried again by the next crawl of the folder, not by this one. fetch takes an address
    and gives a page's text or raises; null addresses are passed over.
    """
    spark = urls.sparkSession
    where, run = _address(spark, folder), uuid.uuid4().hex

    def get(url: str) -> str:
        return fetch(url) if fetch else get_page(url, retries, request_sleep, timeout, agent)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shelf = Shelf(where)
        for batch in batches:
            for url in batch["url"]:
                kept = shelf.get(url)
                if kept is None or (kept["error"] is not None and kept["run"] != run):
                    record = {"url": url, "html": None, "error": None, "tries": (kept or {"tries": 0})["tries"] + 1, "run": run}
                    try:
                        record["html"] = get(url)
                    except Exception as e:  # whatever one page's fetching raises, the others go on
                        record["error"] = str(e) or type(e).__name__
                    shelf.put(record | {"fetched_at": datetime.now(timezone.utc).isoformat()})
                    time.sleep(sleep * tasks)
            yield batch[["url"]]

    asked = frontier(urls, folder).where("state <> 'done'")
    claim = F.pmod(F.xxhash64("url"), F.lit(tasks))
    host = F.regexp_extract("url", r"^[^:]*://([^/?#]*)", 1)
    claimed = asked.select("url", host.alias("host"), claim.alias("claim")).repartition(max(tasks, spark.sparkContext.defaultParallelism), "host", "claim")
    claimed.select("url").mapInPandas(work, "url string").count()
    return shelved(spark, folder).join(urls.select("url").distinct(), "url", "left_semi").select("url", "html", "error")
