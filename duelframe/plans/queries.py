"""One query for each operator, over the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.functions import titles
from duelframe.operators import consolidate, dims, events, incremental, review, uploads
from duelframe.plans import battles as B
from duelframe.plans import fixtures
from duelframe.sources import files, web
from duelframe.sources.staging import new_path

ID = ["id"]


def _flat(df: DataFrame) -> DataFrame:
    """Arrays as text, so that engines can be compared."""
    return df.withColumns({c: F.array_join(c, review.URL_MARK) for c, k in df.dtypes if k.startswith("array")})


def _titled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.uploads(spark, sf_dir).transform(uploads.clean_titles).transform(uploads.copy_title).transform(uploads.strip_part_suffix)


def _battles(spark: SparkSession, sf_dir: str, ordered: bool = False) -> DataFrame:
    return B.battles(fixtures.uploads(spark, sf_dir), fixtures.events(spark, sf_dir), ordered=ordered)


def clean_titles(spark, sf_dir):
    return fixtures.uploads(spark, sf_dir).transform(uploads.clean_titles).select("id", "title")


def parse_upload_date(spark, sf_dir):
    return fixtures.uploads(spark, sf_dir).transform(uploads.parse_upload_date).select("id", "upload_date")


def durations(spark, sf_dir):
    return fixtures.uploads(spark, sf_dir).transform(uploads.add_duration_columns).select("id", "duration_seconds", "duration_hms")


def metrics_numeric(spark, sf_dir):
    return fixtures.uploads(spark, sf_dir).transform(uploads.convert_video_metrics_to_numeric).select("id", "view_count", "likeCount", "commentCount")


def strip_part_suffix(spark, sf_dir):
    return _titled(spark, sf_dir).select("id", "title", "yt_raw_title")


def part_number(spark, sf_dir):
    return _titled(spark, sf_dir).select("id", titles.part_number(F.col("yt_raw_title")).alias("part"), titles.is_part(F.col("yt_raw_title")).alias("is_part"))


def filter_vs(spark, sf_dir):
    return _titled(spark, sf_dir).transform(uploads.filter_titles_with_vs).select("id", "title")


def filter_keywords(spark, sf_dir):
    return _titled(spark, sf_dir).transform(uploads.drop_non_battles).select("id", "title")


def filter_one_on_one(spark, sf_dir):
    return _titled(spark, sf_dir).transform(uploads.keep_one_on_one).select("id", "title")


def extract_matchup(spark, sf_dir):
    return _titled(spark, sf_dir).select("id", titles.matchup(F.col("title")).alias("matchup"))


def split_emcees(spark, sf_dir):
    return _titled(spark, sf_dir).transform(uploads.add_matchup_and_split).select("id", "matchup", "emcee1", "emcee2")


def rename_emcees(spark, sf_dir):
    named = _titled(spark, sf_dir).transform(uploads.add_matchup_and_split).transform(uploads.apply_emcee_rename, names=dims.ALIASES)
    return named.transform(uploads.add_matchup_clean).select("id", "emcee1", "emcee2", "matchup_clean")


def uploads_1v1(spark, sf_dir):
    cols = ["id", "title", "yt_raw_title", "upload_date", "duration_seconds", "duration_hms", "view_count", "matchup", "emcee1", "emcee2", "matchup_clean"]
    return B.make_uploads_1v1(fixtures.uploads(spark, sf_dir)).select(*cols)


def event_descriptions(spark, sf_dir):
    out = fixtures.all_events(spark, sf_dir).transform(events.split_event_description).transform(events.clean_event_location)
    return out.select("video_id", "_ord", "event_date", "event_location", "event_location_clean")


def event_name_from_description(spark, sf_dir):
    return fixtures.uploads(spark, sf_dir).transform(events.extract_event_name).select("id", "event_name_from_desc")


def attach_events(spark, sf_dir):
    out = events.attach_event_metadata(B.make_uploads_1v1(fixtures.uploads(spark, sf_dir)), fixtures.events(spark, sf_dir))
    return out.select("id", "upload_date", "event_name", "event_date", "event_location_clean")


def attach_without_a_key(spark, sf_dir):
    """Events without a video id are joined to nothing."""
    evs = fixtures.events(spark, sf_dir).drop("video_id")
    return events.attach_event_metadata(B.make_uploads_1v1(fixtures.uploads(spark, sf_dir)), evs).select("id", "title", "upload_date")


def _some_without_id(spark, sf_dir):
    ups = B.make_uploads_1v1(fixtures.uploads(spark, sf_dir))
    return ups.withColumn("id", F.when(F.col("id").endswith("7"), None).otherwise(F.col("id")))


def attach_without_ids(spark, sf_dir):
    """A third of events and a tenth of uploads have no id; by default they don't meet."""
    out = events.attach_event_metadata(_some_without_id(spark, sf_dir), fixtures.events(spark, sf_dir))
    return out.select("id", "title", "event_name", "event_date", "event_location_clean")


def attach_null_ids(spark, sf_dir):
    """As before, but null meets null: the first event without an id counts."""
    out = events.attach_event_metadata(_some_without_id(spark, sf_dir), fixtures.events(spark, sf_dir), match_nulls=True)
    return out.select("id", "title", "event_name", "event_date", "event_location_clean")


def parse_dates_of_one_format(spark, sf_dir):
    """Dates of several forms; that of the first order counts."""
    kinds = "case o_orderkey % 5 when 0 then '2020-01-02' when 1 then 'soon' when 2 then '2020-01-02T03:04:05.5Z' when 3 then '2020-01-02T03:04:05+02:00' else '2021-02-03T04:05:06Z' end"
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.expr(f"case when o_orderkey % 7 = 0 then null else {kinds} end").alias("upload_date"))
    free = uploads.parse_upload_date(rows, new_col="each")
    return uploads.parse_upload_date(free, format_by="o_orderkey").select("o_orderkey", "each", "upload_date")


def rename_by_table(spark, sf_dir):
    """Aliases as a table of all customers: more than a plan should hold."""
    names = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.expr("'Rhymer ' || c_custkey || 'x'").alias("alias"), F.expr("'R' || c_custkey").alias("name"))
    named = _titled(spark, sf_dir).transform(uploads.add_matchup_and_split).transform(uploads.apply_emcee_rename, names=names)
    return named.select("id", "emcee1", "emcee2")


def consolidate_parts(spark, sf_dir):
    base = B.make_uploads_1v1(fixtures.uploads(spark, sf_dir)).select("id", "url", "title", "yt_raw_title", "upload_date", "duration_seconds", "description", "emcee1", "emcee2")
    return _flat(consolidate.consolidate_parts(base))


def battles(spark, sf_dir):
    return _flat(_battles(spark, sf_dir, ordered=True))


def emcees(spark, sf_dir):
    return dims.build_emcees(_battles(spark, sf_dir))


def quarantine_battles(spark, sf_dir):
    return _flat(review.quarantine(_battles(spark, sf_dir))).select("id", "title", "upload_date", "event_name")


def quarantined_events(spark, sf_dir):
    return review.quarantined_events(_battles(spark, sf_dir))


def winner_review(spark, sf_dir):
    return review.winner_review(_battles(spark, sf_dir))


def latest_battles(spark, sf_dir):
    return review.latest(_flat(_battles(spark, sf_dir))).select("id", "title", "upload_date")


def incremental_new_ids(spark, sf_dir):
    """All uploads as what comes in, all ids of events as what is there."""
    have = fixtures.events(spark, sf_dir).select(F.col("video_id").alias("id"))
    return incremental.new_rows(fixtures.uploads(spark, sf_dir), have).select("id", "title")


def incremental_append(spark, sf_dir):
    """All uploads as what is there, all events with an id as what comes in; the first event of an id counts."""
    first = events.first_of_each(fixtures.events(spark, sf_dir), "video_id", ["event_name"])
    fresh = first.select(F.concat(F.lit("e"), "video_id").alias("id"), F.col("event_name").alias("title")).unionByName(first.select(F.col("video_id").alias("id"), F.col("event_name").alias("title")))
    return incremental.append_new(fixtures.uploads(spark, sf_dir).select("id", "title"), fresh).select("id", "title")


def _raw(spark: SparkSession, sf_dir: str) -> str:
    """A folder with the two raw files, written by the library's own writers."""
    folder = new_path(spark)
    files.save_uploads(fixtures.uploads(spark, sf_dir), f"{folder}/youtube_videos.json")
    files.write_events(fixtures.events(spark, sf_dir).orderBy("_ord").drop("_ord"), f"{folder}/matchup_events_metadata.csv")
    return folder


def load_uploads(spark, sf_dir):
    return files.load_uploads(spark, f"{_raw(spark, sf_dir)}/youtube_videos.json").drop("tags")


def load_existing(spark, sf_dir):
    return files.load_existing(spark, f"{_raw(spark, sf_dir)}/youtube_videos.json").select("id", "title", "url")


def load_event_metadata(spark, sf_dir):
    return files.load_event_metadata(spark, f"{_raw(spark, sf_dir)}/matchup_events_metadata.csv").drop("_ord")


def build_battles(spark, sf_dir):
    """The battle table from the raw files."""
    return _flat(B.build_battles(spark, _raw(spark, sf_dir), ordered=False))


def battles_csv(spark, sf_dir):
    """What the CSV holds, as text."""
    folder = _raw(spark, sf_dir)
    out = B.write_battles(spark, f"{folder}/battles.csv", folder, "csv", ordered=False)
    return files.read_csv(spark, out)


def battles_ndjson(spark, sf_dir):
    """What the NDJSON holds: times as milliseconds, ids and urls as single texts or lists."""
    folder = _raw(spark, sf_dir)
    out = B.write_battles(spark, f"{folder}/battles.json", folder, "json", ordered=False)
    return spark.read.schema("id string, title string, upload_date long, duration_seconds double, event_date long, url string").json(out)


def battles_one_csv(spark, sf_dir):
    """One file by its name, its kind in capitals."""
    folder = _raw(spark, sf_dir)
    out = B.write_battles(spark, f"{folder}/one.csv", folder, "CSV", one_file=True)
    return files.read_csv(spark, out).select("id", "title", "upload_date", "emcee1", "emcee2", "matchup")


def rename_by_file(spark, sf_dir):
    """Aliases of a JSON object in a file, one for each nation."""
    path = f"{new_path(spark)}/names.json"
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet")
    pairs = nations.agg(F.map_from_entries(F.collect_list(F.struct(F.expr("'Rhymer ' || n_nationkey || 'x'"), F.expr("'R' || n_nationkey")))).alias("names"))
    pairs.select(F.to_json("names").alias("value")).coalesce(1).write.text(path)
    named = _titled(spark, sf_dir).transform(uploads.add_matchup_and_split).transform(uploads.apply_emcee_rename, names=files.load_names(spark, path))
    return named.select("id", "emcee1", "emcee2")


def emcees_csv(spark, sf_dir):
    folder = new_path(spark)
    files.write_emcees(emcees(spark, sf_dir), folder)
    return spark.read.csv(folder, header=True)


def battles_without_events(spark, sf_dir):
    return _flat(B.battles(fixtures.uploads(spark, sf_dir), None, ordered=False))


def battles_of_named_events(spark, sf_dir):
    """Events without descriptions have no dates, so nothing is cleared or filled."""
    return _flat(B.battles(fixtures.uploads(spark, sf_dir), fixtures.events(spark, sf_dir).select("video_id", "event_name", "_ord"), ordered=False))


def consolidate_few_columns(spark, sf_dir):
    """Parts without dates, durations and urls."""
    return _flat(consolidate.consolidate_parts(_titled(spark, sf_dir).select("id", "title", "yt_raw_title")))


def parse_event_date(spark, sf_dir):
    """Dates as texts of several forms."""
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.expr("case o_orderkey % 4 when 0 then cast(o_orderdate as string) when 1 then '2020-01-02' when 2 then 'soon' end").alias("event_date"))
    return events.parse_event_date(rows)


def page_links(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return web.hrefs(pages).select("page_id", "place", "href")


def first_links(spark, sf_dir):
    links = page_links(spark, sf_dir).withColumn("_ord", F.struct("page_id", "place"))
    return events.first_of_each(links, "href", ["page_id", "place"])


def event_links(spark, sf_dir):
    box = lambda href, title: f"<a href=\"{href}\"><div class=\"card ft-article\"><h4> {title} </h4></div></a>"
    html = "concat('" + box("/videos/battle/ahon-', o_orderkey % 50, '", "Ahon &amp; ', o_orderkey % 50, '") + box("/videos/battle/ahon-', o_orderkey % 50, '", "Again") + box("/videos/battle/x/y", "Nested") + box("/videos/battle/gubat", "Gubat") + "')"
    listings = fixtures.orders(spark, sf_dir).select(F.expr("concat('l', o_orderkey)").alias("url"), F.expr(html).alias("html"))
    return web.event_links(listings, "http://x.test/")


def scrape_match_rows(spark, sf_dir):
    html = """'<h2 class="display-7">Ahon ' || o_orderkey % 20 || '</h2><div class="col-md-9"><small>Bar League presents: Ahon @ Makati. Dec. 1, 2020</small></div>
      <div class="container-xxl"><div class="row my-4"><div class="col-md-5 my-3"><div class="youtube-player" data-id="v' || o_orderkey || '"></div></div>
      <div class="col-md-7 my-3"><h4> Flip vs <b>Emcee ' || o_custkey || '</b> x (rematch)</h4></div></div></div>'"""
    pages = fixtures.orders(spark, sf_dir).select(F.expr("concat('http://x.test/videos/battle/ahon-', o_orderkey)").alias("url"), F.expr(html).alias("html"))
    return web.scrape_pages(pages, dims.ALIASES)


def scrape_listed_years(spark, sf_dir):
    """Five years' listings, each with its orders' pages and the next year's; a page that two years list counts for both, and one that is gone for none.

    A year's listing comes in pages of at most 400 links, as many of them as the year has, so that none is a group that holds a year.
    """
    orders = fixtures.orders(spark, sf_dir)
    year = orders.select("o_orderkey", F.expr("o_orderkey div 1000").alias("page"), F.explode(F.expr("array(o_orderkey % 5, (o_orderkey + 1) % 5)")).alias("year"))
    card = F.expr("""concat('<a href="/videos/battle/e', o_orderkey, '"><div class="ft-article"><h4>E</h4></div></a>')""")
    listings = year.groupBy("year", "page").agg(F.array_join(F.collect_list(card), "").alias("html")).select(F.expr("'http://x.test/videos/battle?year=' || year || '&page=' || page").alias("url"), "html", F.lit(None).cast("string").alias("error"))
    html = """concat('<h2 class="display-7">E', o_orderkey, '</h2><div class="row my-4"><div class="col-md-5 my-3"><div class="youtube-player" data-id="v', o_orderkey, '"></div></div><div class="col-md-7 my-3"><h4>A vs B', o_custkey, 'z</h4></div></div>')"""
    gone = "o_orderkey % 11 = 0"
    site = orders.select(F.expr("'http://x.test/videos/battle/e' || o_orderkey").alias("url"), F.expr(f"if({gone}, null, {html})").alias("html"), F.expr(f"if({gone}, 'gone', null)").alias("error"))
    rows, failed = web.scrape_listings(listings, "http://x.test", lambda urls: site.join(urls, "url", "left_semi"))
    return rows.select("matchup", "event_name", "video_id").unionByName(failed.select(F.lit("failed").alias("matchup"), F.col("url").alias("event_name"), F.col("error").alias("video_id")))


def pages_of_all_kinds(spark, sf_dir):
    """Pages whose row is another than the first, with fewer headings than ids, with neither, with a name, with nothing, and 5 or 5,000 elements deep."""
    box = lambda k, n: f"<div class=\"col-md-5 my-3\"><div class=\"youtube-player\" data-id=\"v{k}-' || o_orderkey || '\"></div></div>" * (n > 0) + f"<div class=\"col-md-7 my-3\"><h4>A{k} vs B{k}</h4></div>" * (n > 1)
    row = lambda body: f"<div class=\"row my-4\">{body}</div>"
    kinds = [
        f"<div class=\"container-xxl\">{row(box(1, 2))}</div>{row(box(2, 2))}",  # the first row
        f"{row(box(3, 2))}<div class=\"container-xxl\">{row(box(4, 2))}</div>",  # the row in the container
        f"<p>x</p>{row(box(5, 2))}{row(box(6, 2))}",  # no container: the first row of all
        f"<div class=\"container-xxl\">{row(box(7, 2) + box(8, 1))}</div>",  # an id without a heading
        f"<h2 class=\"display-7\">Named</h2>{row(box(9, 2))}",
        "nothing",
    ]
    texts = " ".join(f"when {k} then '{x}'" for k, x in enumerate(kinds))
    html = f"case o_orderkey % 7 {texts} else repeat('<div>', case when o_orderkey % 700 = 6 then 5000 else 5 end) || '{row(box(10, 2))}' end"
    pages = fixtures.orders(spark, sf_dir).select(F.expr("concat('http://x.test/videos/battle/ahon-', o_orderkey, '/')").alias("url"), F.expr(html).alias("html"))
    return web.scrape_pages(pages)


def any_case_alias(spark, sf_dir):
    names = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.expr("case o_orderkey % 5 when 0 then ' FLIP ' when 1 then 'flip' when 2 then 'M-ZHAYT' when 3 then null else 'Other' end").alias("raw"))
    return names.select("o_orderkey", titles.canonical_any_case(F.col("raw"), dims.ALIASES).alias("name"))


QUERIES = {f.__name__: f for f in (
    clean_titles, parse_upload_date, durations, metrics_numeric, strip_part_suffix, part_number, filter_vs, filter_keywords,
    filter_one_on_one, extract_matchup, split_emcees, rename_emcees, uploads_1v1, event_descriptions, event_name_from_description,
    attach_events, attach_without_a_key, attach_without_ids, attach_null_ids, parse_dates_of_one_format, rename_by_table, consolidate_parts, battles, emcees, quarantine_battles, quarantined_events, winner_review, latest_battles,
    incremental_new_ids, incremental_append, page_links, first_links, event_links, scrape_match_rows, any_case_alias,
    load_uploads, load_existing, load_event_metadata, build_battles, battles_csv, battles_ndjson, emcees_csv, battles_without_events,
    battles_of_named_events, consolidate_few_columns, parse_event_date, pages_of_all_kinds, battles_one_csv, rename_by_file, scrape_listed_years,
)}
