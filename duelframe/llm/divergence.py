"""How the sources of a language differ, by the terms that they use.

Document frequencies of terms go into count-min sketches first: tasks fill them, Spark
merges them, and terms that can't be in enough documents are left out before anything
is shuffled. What is left is counted exactly by language, source and term, and terms in
too few documents after all go. Two sources are compared by a sum over all terms of
their language, most of which neither has, or only one: these follow from the numbers of
terms with equal counts, and only terms that both have are joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.common import lean, materialize, table
from duelframe.llm.sketch import PAGES, CountMin, gathered, merge, mixed

MIN_DOCS = 3
#: Terms of a source that are told.
TOP = 200
#: Shares are whole numbers of this part.
ONE = 1_000_000_000
#: Rows of a sketch, and the cells of a row as a power of two: 384 KB of bits for every task.
DEPTH, BITS = 3, 20
#: Terms that a task holds before it hands them on.
HELD = 400_000
#: Letters of ASCII in lower case, all bytes beyond ASCII as they are, and spaces.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of ASCII letters, lower-cased, and of all characters beyond ASCII, of UTF-8."""
    return text.translate(_TERMS).split()


def _hashes(lang: str, held: Counter) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return mixed(np.fromiter((xxhash.xxh64_intdigest(t, seed) for t in held), np.uint64, len(held)))


def _fill(bits: int, min_docs: int):
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pages of a sketch of the terms' document frequencies."""
        sketch, held = CountMin(min_docs, 1, DEPTH, bits), {}

        def empty() -> None:
            for lang, docs in held.items():
                sketch.add(0, _hashes(lang, docs), np.fromiter(docs.values(), np.int64, len(docs)))
            held.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                held.setdefault(lang, Counter()).update(set(terms(text)))
            if sum(map(len, held.values())) > HELD:
                empty()
        empty()
        yield from sketch.pages()

    return fill


def _count(reached, step: int = 20_000):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(lang, source, term, n, docs) of the terms that the sketch lets pass, several times if a task has many."""
        words, docs, held = {}, {}, 0

        def told() -> Iterator[pa.RecordBatch]:
            for (lang, source), ns in words.items():
                may = reached.value(0, _hashes(lang, ns)).tolist()
                ts, ds = list(compress(ns, may)), docs[lang, source]
                for at in range(0, len(ts), step):
                    some = ts[at : at + step]
                    columns = [pa.repeat(lang, len(some)), pa.repeat(source, len(some)), pa.array(some, pa.binary())]
                    columns += [pa.array(list(map(of.__getitem__, some)), pa.int64()) for of in (ns, ds)]
                    yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            words.clear()
            docs.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                said, group = terms(text), (lang, source)
                if group not in words:
                    words[group], docs[group] = Counter(), Counter()
                held -= len(words[group])
                words[group].update(said)
                docs[group].update(set(said))
                held += len(words[group])
                if held > HELD:
                    yield from told()
                    held = 0
        yield from told()

    return count


def _div(a: Column, b: Column) -> Column:
    """The whole part of a / b, both at least 0."""
    return F.call_function("div", a, b)


def share(n: Column, total: Column) -> Column:
    """1 + floor(ONE * (n + 1) / total), exact: in 64 bits where they hold the product, and in decimals beyond."""
    wide = _div((n + 1).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(10,0)"), total.cast("decimal(20,0)"))
    return F.lit(1) + F.when(total < (1 << 63) // ONE, _div(F.lit(ONE) * (n + 1), total)).otherwise(wide)


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q)."""
    return _div((p - q) * (p - q), q)


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS, bits: int = BITS) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of rows (lang, source, text): terms in at least min_docs documents of a language.

    n counts a term in a source of the language, lang_n in all of it; first marks one
    row of each term of a language.
    """
    rows = gathered(docs.select("lang", "source", F.col("text").cast("binary").alias("text")))
    pages = rows.select("lang", "text").mapInPandas(_fill(bits, min_docs), PAGES)
    reached = docs.sparkSession.sparkContext.broadcast(merge(pages, min_docs, 1, DEPTH, bits))
    told = rows.mapInArrow(_count(reached), "lang string, source string, term binary, n long, docs long")
    exact = told.groupBy("lang", "source", F.col("term").cast("string").alias("term")).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = Window.partitionBy("lang", "term")
    known = exact.select("lang", "source", "term", "n", F.sum("docs").over(own).alias("docs"), F.sum("n").over(own).alias("lang_n"), (F.min("source").over(own) == F.col("source")).alias("first"))
    return materialize(known.where(F.col("docs") >= min_docs).drop("docs"))


def _pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the gaps of a source to each other one, over all terms.

    p0 is the share of a term that a group doesn't have. All terms count as if neither
    had them; then those that one has are put right, by the numbers of equal shares, and
    then those that both have, by a join.
    """
    x, y = rows.alias("x"), rows.alias("y")
    met = x.join(y, (F.col("x.lang") == F.col("y.lang")) & (F.col("x.term") == F.col("y.term")) & (F.col("x.source") < F.col("y.source")))

    def both(a: str, b: str) -> Column:
        p, p0, q, q0 = (F.col(c) for c in (f"{a}.p", f"{a}.p0", f"{b}.p", f"{b}.p0"))
        return F.sum(gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0))

    def turned(df: DataFrame, there: Column, back: Column) -> DataFrame:
        way = lambda a, b, v: F.struct(F.col(a).alias("source"), F.col(b).alias("item"), v.alias("value"))
        return df.select("lang", F.explode(F.array(way("one", "two", there), way("two", "one", back))).alias("w")).select("lang", "w.*")

    shared = met.groupBy(F.col("x.lang").alias("lang"), F.col("x.source").alias("one"), F.col("y.source").alias("two")).agg(both("x", "y").alias("there"), both("y", "x").alias("back"))
    alike = rows.groupBy("lang", F.col("source").alias("one"), "p", "p0").agg(F.count("*").alias("c"))
    others = groups.select(F.col("lang"), F.col("source").alias("two"), F.col("p0").alias("q0"))
    one = alike.join(others, "lang").where("one <> two")
    p, p0, q0, c = (F.col(k) for k in ("p", "p0", "q0", "c"))
    one = one.groupBy("lang", "one", "two").agg(F.sum(c * (gap(p, q0) - gap(p0, q0))).alias("there"), F.sum(c * (gap(q0, p) - gap(q0, p0))).alias("back"))
    none = groups.select("lang", F.col("source").alias("one"), "p0", "kept").join(others, "lang").where("one <> two")
    none = none.select("lang", F.col("one").alias("source"), F.col("two").alias("item"), (F.col("kept") * gap(p0, q0)).alias("value"))
    parts = none.unionByName(turned(shared, F.col("there"), F.col("back"))).unionByName(turned(one, F.col("there"), F.col("back")))
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", *, min_docs: int = MIN_DOCS, top: int = TOP, bits: int = BITS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source of a language is from the others, and by which terms.

    Part pair has every other source of the language, part term the `top` terms by which
    a source stands out from its language. A share is of the terms in at least min_docs
    of the language's documents, each counted once more than it occurs.

    Null texts, languages and sources count as empty. A source without terms is compared
    like any other; without any kept term all values are 0. A repeated row is a document
    of its own; ties go by the item in the order of UTF-8. An empty table gives an empty
    result; other columns aren't read. Texts of any length are taken whole, one at a
    time. Values fit in 64 bits while a language has fewer than 10**9 kept terms. bits is
    the size of a sketch's row; with too few no term is lost, but more are shuffled.

    A task holds HELD terms, a text's words and 3 rows of cells; the driver receives a
    bit for each cell. A frequent term or a hot source is a row for each task and source
    before it is shuffled. The pairs of sources are what is asked for, so rows grow with
    the square of a language's sources, and the join with that of a term's.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    kept = term_counts(rows, min_docs, bits)
    langs = kept.groupBy("lang").agg(F.count_if("first").alias("kept"), F.sum("n").alias("lang_words"))
    words = kept.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    groups = rows.select("lang", "source").distinct().join(words, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["words", "kept", "lang_words"])
    total = lambda c: F.greatest(F.col(c) + F.col("kept"), F.lit(1))
    groups = lean(groups.select("lang", "source", "kept", total("words").alias("total"), total("lang_words").alias("lang_total")).withColumn("p0", share(F.lit(0).cast("long"), F.col("total"))))
    shares = kept.join(groups, ["lang", "source"]).withColumn("p", share(F.col("n"), F.col("total")))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    out = ("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
    pairs = _pairs(shares.select("lang", "source", "term", "p", "p0"), groups).withColumn("rank", F.row_number().over(best)).withColumn("part", F.lit("pair"))
    q = share(F.col("lang_n"), F.col("lang_total"))
    told = shares.withColumn("q", q).where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    told = told.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    return pairs.select(*out).unionByName(told.select(*out))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


SQL = r"""
with d as (
  select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
t as (select doc, lang, source, unnest(w) as term from d),
kept as (select lang, term, count(*) as lang_n from t group by lang, term having count(distinct doc) >= 3),
c as (select t.lang, t.source, t.term, count(*) as n from t join kept using (lang, term) group by all),
v as (select lang, count(*) as v, sum(lang_n) as lang_words from kept group by lang),
g as (
  select s.lang, s.source, coalesce(w.words, 0) as words, coalesce(v.v, 0) as v, coalesce(v.lang_words, 0) as lang_words
  from (select distinct lang, source from d) s left join v using (lang)
    left join (select lang, source, sum(n) as words from c group by all) w using (lang, source)),
p as (
  select g.lang, g.source, kept.term, coalesce(c.n, 0) as n,
    1 + (1000000000::hugeint * (coalesce(c.n, 0) + 1)) // (words + v)::hugeint as p,
    1 + (1000000000::hugeint * (kept.lang_n + 1)) // (lang_words + v)::hugeint as q
  from g join kept using (lang) left join c using (lang, source, term)),
pairs as (
  select g.lang, g.source, o.source as item, coalesce(x.value, 0) as value
  from g join g o on g.lang = o.lang and g.source <> o.source
    left join (
      select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
      from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all) x
      on x.lang = g.lang and x.source = g.source and x.item = o.source),
found as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pairs
  union all
  select * from (
    select lang, source, 'term', term, ((p - q) * (p - q)) // q as value, row_number() over (partition by lang, source order by ((p - q) * (p - q)) // q desc, term) as rank
    from p where n > 0 and p > q) x
  where rank <= 200)
select lang, source, part, item, value::bigint as value, rank::int as rank from found
"""
