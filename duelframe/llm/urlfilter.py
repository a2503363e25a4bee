"""URL filters: rules on hosts and path prefixes, found by hashes of expressions.

A URL stands for expressions host-suffix + path-prefix, and so does a rule. URLs
meet rules in an equi-join on the first digits of the expressions' SHA-256; the
whole digest then confirms the match, and the longest rule wins. Only DataFrame
functions take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.common import lean, table

#: Hexadecimal digits of a digest that the join compares.
PREFIX_DIGITS = 8
DEFAULT_VERDICT = "allow"
#: Distinct URLs with their verdicts that every task may be given; more are joined by shuffles, which AQE splits where a URL is hot.
MOST_URLS = 1 << 15

#: (verdict, host, path): the rules of the query.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column, most: int) -> Column:
    """The host and each domain above it, of those with at most so many labels: a.b.c, b.c, c. An empty host has none."""
    known = F.substring_index(host, ".", -most)  # no more of a long host is ever joined
    labels = F.split(known, r"\.", -1)
    return F.when(host != "", F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))).otherwise(F.array().cast("array<string>"))


def _expression(host: Column, path: Column) -> Column:
    """A host has no slash, and a path is empty or starts with one, so this can be told apart."""
    return F.concat(host, F.lit("\n"), path)


def rule_table(rules: DataFrame) -> DataFrame:
    """(verdict, host, path) -> the rules with their digests.

    Hosts are lower-cased; rules with a null in any column are void. Of rules with
    the same host and path one is left, block before allow.
    """
    clean = rules.select(F.col("verdict"), F.translate("host", _UPPER, _LOWER).alias("rule_host"), F.col("path").alias("rule_path")).where("verdict is not null and rule_host <> '' and rule_path is not null")
    one = clean.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    digest = F.sha2(_expression(F.col("rule_host"), F.col("rule_path")), 256)
    return one.withColumn("digest", digest).withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """(url, host, path, rule, verdict) for each distinct url of pages.

    A rule fits its host and all subdomains if the URL's path starts with the
    rule's path. The longest rule (host and path together) wins; of equally long
    ones that with the longer host, then block before allow, then the greater text.
    Without one, rule is null and the verdict is allow. A null or relative URL has
    an empty host, which no rule fits. Without rules all is allowed.

    A path is cut at the lengths that rules' paths have, and a host at the most labels
    that a rule's has, so the expressions of a URL are as many as these labels times
    these lengths, however long it is. The driver receives the distinct lengths, no
    more than the longest rule's path has characters.
    """
    known = rule_table(rules)
    seen = known.groupBy(F.length("rule_path").alias("n")).agg(F.max(F.size(F.split("rule_host", r"\.", -1))).alias("labels")).collect()
    lengths, labels = sorted(r.n for r in seen), max([1, *(r.labels for r in seen)])
    urls = pages.select(F.col(url_col).alias("url")).distinct().select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    fits = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.length("path"))
    spread = urls.select("url", "path", F.explode(host_suffixes(F.col("host"), labels)).alias("suffix"), fits.alias("fits")).select("url", "path", "suffix", F.explode("fits").alias("n"))
    digest = F.sha2(_expression(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("n"))), 256)
    asked = spread.select("url", digest.alias("asked")).withColumn("prefix", F.substring("asked", 1, PREFIX_DIGITS))
    hits = asked.join(known, "prefix").where(F.col("asked") == F.col("digest"))
    rank = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("m"), "rule_verdict", F.concat("rule_host", "rule_path").alias("rule"))
    best = hits.groupBy("url").agg(F.max(rank).alias("best")).select("url", F.col("best.rule").alias("rule"), F.col("best.rule_verdict").alias("found"))
    return urls.join(best, "url", "left").select("url", "host", "path", "rule", F.coalesce("found", F.lit(DEFAULT_VERDICT)).alias("verdict"))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) for each row of pages; see judge_urls.

    Equal URLs are judged once. Repeated rows come back as often as they are, null
    ids too; an empty table gives an empty result; other columns aren't read.
    """
    named = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    given, none = named.where("url is not null"), named.where("url is null")
    judged = lean(judge_urls(given, rules).withColumnRenamed("url", "judged"), MOST_URLS)
    out = given.join(judged, F.col("url") == F.col("judged")).select(id_col, "host", "path", "rule", "verdict")
    empty = F.lit("")
    return out.unionByName(none.select(id_col, empty.alias("host"), empty.alias("path"), F.lit(None).cast("string").alias("rule"), F.lit(DEFAULT_VERDICT).alias("verdict")))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


SQL = r"""
with parts as (
  select page_id,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path,
    row_number() over () as r
  from pages),
rules(verdict, rule_host, rule_path) as (
  values ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'),
         ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
hits as (
  select r, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         arg_max(verdict, length(rule_host || rule_path)) as verdict
  from parts join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by r)
select page_id, host, path, hits.rule as rule, coalesce(hits.verdict, 'allow') as verdict
from parts left join hits using (r)
"""
