"""Event pages of a league's site: links of a listing, and the matchups of a page.

Pages are rows (url, html); they may be fetched by fetch_pages or come from a table.
Small parsers, run as Python table functions, take the elements out of the HTML;
names, filters and matchups are made by Spark.
"""

from __future__ import annotations

import re
import time
from collections import defaultdict
from collections.abc import Callable, Iterator, Mapping
from functools import reduce
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.functions import patterns as P
from duelframe.functions.text import holds, replace, split_first, strip
from duelframe.functions.titles import canonical_any_case
from duelframe.sources.crawl import AGENT, crawl, get_page
from duelframe.sources.staging import new_path, staged

# The pages' addresses and the classes of their elements.
LISTING = "/videos/battle"
LINK_PREFIX = "/videos/battle/"
LINK = r"^/videos/battle/[^/]+\z"
_VOID = set("area base br col embed hr img input link meta source track wbr".split())


#: Elements that end where one like them begins, and what may stand open between the two.
_ENDED_BY = {"li": {"li"}, "p": {"p"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}}
_INLINE = set("a abbr b big cite code em font i mark q s small span strong sub sup u".split())


class Element:
    """An element of a page; within holds the elements in the order of the page, of which those from at + 1 to before until are inside."""

    __slots__ = ("tag", "attrs", "parent", "parts", "classes", "within", "at", "until")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None, within: list[Element]):
        self.tag, self.attrs, self.parent, self.parts = tag, attrs, parent, []
        self.classes = set(attrs["class"].split()) if "class" in attrs else _NONE
        self.within, self.at, self.until = within, len(within), None

    def walk(self) -> Iterator[Element | str]:
        """All elements and texts inside, in the order of the page, however deep they are."""
        stack = self.parts[::-1]
        while stack:
            x = stack.pop()
            yield x
            if isinstance(x, Element):
                stack += x.parts[::-1]

    def all(self, tag: str | None = None, *classes: str) -> Iterator[Element]:
        inside = self.within[self.at + 1 : self.until]
        return (x for x in inside if (tag is None or x.tag == tag) and x.classes.issuperset(classes))

    def first(self, tag: str | None = None, *classes: str) -> Element | None:
        return next(self.all(tag, *classes), None)

    def texts(self) -> Iterator[str]:
        return (x.strip() for x in self.walk() if isinstance(x, str) and x.strip())


_NONE: frozenset[str] = frozenset()
#: A tag that any reader takes alike, or a text; the attributes are in group 3.
_PLAIN = re.compile(r'<(/?)([a-z][a-z0-9]*)((?: [a-z][a-z-]*="[^"<>]*")*)>|([^<]+)')
_ATTRIBUTE = re.compile(r' ([a-z-]+)="([^"]*)"')
#: Elements whose inside is no markup.
_RAW = set("iframe noembed noframes noscript plaintext script style textarea title xmp".split())


class _Tree(HTMLParser):
    """The tree of a page. With only, what is outside of such elements is not kept, and each outermost one goes to self.found as it ends."""

    def __init__(self, html: str, only: str | None = None):
        super().__init__(convert_charrefs=True)
        self.only, self.within = only, []
        self.root = self.at = Element("", {}, None, [])
        self.root.within, self.root.at = self.within, -1
        self.open: defaultdict[str, int] = defaultdict(int)
        self.read(html)
        while self.at is not self.root:
            self._end(self.at)

    def read(self, html: str) -> None:
        """Plain tags and texts by one pattern; from the first thing that isn't plain on, by HTMLParser."""
        done = 0
        for m in iter(_PLAIN.scanner(html).match, None):
            end, tag, attrs, text = m.groups()
            if text is not None:
                if m.end() == len(html):  # HTMLParser knows what the last text's end means
                    break
                self.handle_data(unescape(text) if "&" in text else text)
            elif tag in _RAW or (end and attrs):
                break
            elif end:
                self.handle_endtag(tag)
            else:
                self.handle_starttag(tag, [(k, unescape(v) if "&" in v else v) for k, v in _ATTRIBUTE.findall(attrs)] if attrs else ())
            done = m.end()
        if done < len(html):
            self.feed(html[done:])
            self.close()

    def found(self, x: Element) -> None:
        """An outermost element of the kind `only` has ended."""

    def _end(self, x: Element) -> None:
        while self.at is not x.parent:
            self.open[self.at.tag] -= 1
            self.at.until = len(self.within)
            if self.at.tag == self.only and not self.open[self.only]:
                self.found(self.at)
                self.within = []
            self.at = self.at.parent

    def _add(self, tag: str, attrs) -> Element:
        new = Element(tag, {k: v or "" for k, v in attrs}, self.at, self.within)
        if self.only is None or tag == self.only or self.open[self.only]:
            self.within.append(new)
            if self.only is None or self.open[self.only]:
                self.at.parts.append(new)
        return new

    def handle_starttag(self, tag, attrs):
        if ended := _ENDED_BY.get(tag):
            x = self.at
            while x.tag in _INLINE:
                x = x.parent
            while x.tag in ended:  # of a row, its cell and then the row
                self._end(x)
                x = self.at
        new = self._add(tag, attrs)
        if tag not in _VOID:
            self.at = new
            self.open[tag] += 1
        else:
            new.until = new.at + 1

    def handle_startendtag(self, tag, attrs):
        new = self._add(tag, attrs)
        new.until = new.at + 1
        if tag == self.only and not self.open[tag]:
            self.found(new)
            self.within = []

    def handle_endtag(self, tag):
        if self.open[tag]:
            x = self.at
            while x.tag != tag:
                x = x.parent
            self._end(x)

    def handle_data(self, data):
        if self.only is None or self.open[self.only]:
            self.at.parts.append(data)


class _Listing(_Tree):
    """(place, event name, href) of the titled links, taken as each outermost link ends, so a long listing is never a tree."""

    def __init__(self, html: str):
        self.rows: list[tuple[int, str, str]] = []
        super().__init__(html, "a")

    def found(self, x: Element) -> None:
        for a in (x, *x.all("a")):
            title = next((h for box in a.all(None, "ft-article") for h in box.all("h4")), None)
            if title is not None and a.attrs.get("href", "").startswith(LINK_PREFIX):
                self.rows.append((len(self.rows), "".join(title.texts()), a.attrs["href"]))


def listing_links(html: str) -> Iterator[tuple[int, str, str]]:
    """(place, event name, href) of a listing's titled links."""
    yield from _Listing(html).rows


def page_matches(url: str, html: str) -> Iterator[tuple[int, str, str, str | None, str]]:
    """(place, event name, description, video id, heading) of a page's matchups, ids and headings paired in order."""
    root = _Tree(html).root
    head = root.first("h2", "display-7")
    name = "".join(head.texts()) if head else url.rstrip("/").split("/")[-1].replace("-", " ").title()
    small = next((s for box in root.all("div", "col-md-9") for s in box.all("small")), None)
    description = " ".join(small.texts()) if small else ""
    rows = list(root.all("div", "row", "my-4"))
    top = next((r for r in rows if r.parent.tag == "div" and "container-xxl" in r.parent.classes), rows[0] if rows else None)
    if top is None:
        return

    def inside(box: str, tag: str, *classes: str) -> list[Element]:
        seen: dict[int, Element] = {}
        for b in top.all("div", box, "my-3"):
            for x in b.all(tag, *classes):
                seen.setdefault(id(x), x)
        return list(seen.values())

    for k, (video, h4) in enumerate(zip(inside("col-md-5", "div", "youtube-player"), inside("col-md-7", "h4"), strict=False)):
        yield k, name, description, video.attrs.get("data-id") or None, " ".join(h4.texts())


@F.udtf(returnType="place int, event_name string, href string, error string")
class ListingLinks:
    def eval(self, html: str):
        try:
            for row in list(listing_links(html or "")):
                yield *row, None
        except Exception as e:  # a listing that can't be read is told of, and the others go on
            yield None, None, None, f"{type(e).__name__}: {e}"


@F.udtf(returnType="place int, event_name string, event_description string, video_id string, heading string, error string")
class PageMatches:
    def eval(self, url: str, html: str):
        try:
            for row in list(page_matches(url or "", html or "")):
                yield *row, None
        except Exception as e:  # a page that can't be read is told of, and the others go on
            yield None, None, None, None, None, f"{type(e).__name__}: {e}"


def listing_rows(listings: DataFrame) -> DataFrame:
    """(listing, place, event_name, href, error) of listings (url, html): every titled link, or why a listing can't be read."""
    return listings.select("url", "html").lateralJoin(ListingLinks(F.col("html").outer())).select(F.col("url").alias("listing"), "place", "event_name", "href", "error")


def page_rows(pages: DataFrame) -> DataFrame:
    """(url, place, event_name, event_description, video_id, heading, error) of pages (url, html): every matchup's heading, or why a page can't be read."""
    found = pages.select("url", "html").lateralJoin(PageMatches(F.col("url").outer(), F.col("html").outer()))
    return found.select("url", "place", "event_name", "event_description", "video_id", "heading", "error")


def event_links(listings: DataFrame, base: str) -> DataFrame:
    """(listing, event_name, url) of listings (url, html): single-slug pages only, the first of each url in a listing.

    Links begin at the root of the site, so only the scheme and host of base count.
    """
    return _links(listing_rows(listings), base)


def _links(rows: DataFrame, base: str) -> DataFrame:
    links = rows.where(F.col("href").rlike(LINK))
    first = links.groupBy("listing", "href").agg(F.min_by("event_name", "place").alias("event_name"))
    return first.select("listing", "event_name", F.concat(F.lit(urljoin(base, "/").rstrip("/")), "href").alias("url"))


def hrefs(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Every href of pages as rows (of the other columns and href), in order, without a parser."""
    found = F.regexp_extract_all(html_col, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), F.lit(1))
    return pages.select(*[c for c in pages.columns if c != html_col], F.posexplode(found).alias("place", "href"))


def matchups(rows: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """(matchup, event_name, event_description, video_id) of headings that name two.

    Names are made canonical before the right side loses what follows @, |, ( or *,
    and a number at its end.
    """
    rows = rows.where("heading is not null")
    ok = holds(F.col("heading"), P.VERSUS) & F.length("heading").between(3, 100)
    sides = split_first(F.col("heading"), P.VERSUS)
    one = canonical_any_case(F.get(sides, F.lit(0)), names or {})
    two = F.regexp_replace(canonical_any_case(F.get(sides, F.lit(1)), names or {}), r"(?sU)\s*[@|(*].*\z", "")
    two = strip(replace(strip(two), P.TRAILING_NUMBER, flags="dU"))
    return rows.where(ok).select(F.concat(one, F.lit(" vs "), two).alias("matchup"), "event_name", "event_description", "video_id")


def scrape_pages(pages: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """The matchups of pages (url, html). Pages that can't be read have none; page_rows tells why."""
    return matchups(page_rows(pages), names)


def fetch_pages(urls: DataFrame, sleep: float = 0.6, retries: int = 2, request_sleep: float = 0.7, timeout: float = 30, agent: str = AGENT, tasks: int = 1) -> DataFrame:
    """(url, html, error) of urls; a page that fails has an error and no html. tasks fetch at once, each at its own pace."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for url in batch["url"]:
                try:
                    row = (url, get_page(url, retries, request_sleep, timeout, agent), None)
                except RuntimeError as e:
                    row = (url, None, str(e))
                yield pd.DataFrame([row], columns=["url", "html", "error"])
                time.sleep(sleep)

    return urls.select("url").repartition(tasks).mapInPandas(fetch, "url string, html string, error string")


def scrape_listings(listings: DataFrame, base: str, pages_of: Callable[[DataFrame], DataFrame], names: Mapping[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The matchups of all pages that listings (url, html, error) link to, for each listing; and (url, error) of all that failed.

    pages_of takes the links' (url) and gives (url, html, error). Links and matchups are
    written once, so that reading both results, or either twice, parses nothing again.
    """
    spark = listings.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = staged(listing_rows(listings.where("html is not null")))
    links = _links(found.where("error is null"), base)
    pages = pages_of(links.select("url").distinct())
    rows = staged(page_rows(pages.where("html is not null").repartition(tasks)))
    failed = [listings, pages, found.withColumnRenamed("listing", "url"), rows]
    errors = reduce(DataFrame.unionByName, [x.where("error is not null").select("url", "error") for x in failed])
    return matchups(links.select("listing", "url").join(rows, "url"), names), errors


def scrape_years(spark: SparkSession, start: int, end: int, base: str, names: Mapping[str, str] | None = None, folder: str | None = None, **fetching) -> tuple[DataFrame, DataFrame]:
    """The matchups of all events of the years from start to end, both included, none if end is before start; and (url, error) of all that failed.

    What is fetched is kept in folder, where a later run finds it; without one it goes
    with the application, but no lost executor costs a second request. A page that
    several years list is fetched once, and its matchups come for each.
    """
    folder = folder or new_path(spark)
    years = spark.range(start, end + 1).select(F.concat(F.lit(base.rstrip("/") + LISTING + "?year="), F.col("id").cast("string")).alias("url"))
    return scrape_listings(crawl(years, f"{folder}/listings", **fetching), base, lambda urls: crawl(urls, f"{folder}/events", **fetching), names)
