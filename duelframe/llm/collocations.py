"""Phrases whose words keep together, mined in two passes over the texts.

The first pass adds all runs of one to four words to count-min sketches, a table for
each length, which Spark merges: they may overestimate a count and never underestimate
it. The second pass counts exactly, and only what the sketches let pass and whose own
parts they let pass, so nothing frequent is lost and little else is shuffled. A phrase
is scored by the worse of its cuts, and goes if a longer one takes most of its places.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.common import lean, materialize, table
from duelframe.llm.sketch import PAGES, CountMin, gathered, merge, mixed

LEAST, MOST = 2, 4
MIN_COUNT = 30
TOP = 2000
#: A phrase goes if a longer one has this share of its count, as a ratio of whole numbers.
SUBSUMED = (80, 100)
#: Rows of a sketch, and the cells of a row as a power of two: 16 MB of bits for every task.
DEPTH, BITS = 2, 24
#: Bytes of text taken at once, and distinct words and phrases of all languages that a task remembers.
SLICE, WORDS, HELD = 1 << 20, 200_000, 1_000_000
#: ASCII in lower case; what ends a piece is a line feed, a tab is a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_END = b"\n"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def word_runs(texts: Iterable[bytes], size: int = SLICE) -> Iterator[tuple[list[bytes], int]]:
    """(words, old) of texts, about size bytes at a time, with a line feed after each piece.

    The first `old` words are the last ones of the run before, so that every phrase
    of at most MOST words is whole in the run that its last word is new in.
    """
    data = _END.join(texts).translate(_FOLD).replace(_END, b" \n ")
    at, last = 0, []
    while at < len(data):
        end = data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        words = last + list(filter(None, data[at:end].split(b" ")))
        yield words, len(last)
        at, last = end, words[-(MOST - 1) :]


class _Ids(dict):
    """Words of a language -> numbers from 1, with hashes; 0 is the end of a piece."""

    def __init__(self, lang: str):
        self.seed, self.hashes = xxhash.xxh32_intdigest(lang.encode()), [0]
        self[_END] = 0

    def __missing__(self, word: bytes) -> int:
        self.hashes.append(xxhash.xxh64_intdigest(word, self.seed))
        self[word] = found = len(self.hashes) - 1
        return found


def grams(ids: np.ndarray, hashes: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, whole, hash) for the runs of k words from each place on: whole if no piece ends in them."""
    one, h1 = ids > 0, hashes[ids]
    whole, h = one, h1
    for k in range(1, most + 1):
        if k > 1:
            whole, h = whole[:-1] & one[k - 1 :], h[:-1] * _BASE + h1[k - 1 :]
        yield k, whole, mixed(h)


class _Runs:
    """The words of a batch's texts by language, as numbers."""

    def __init__(self):
        self.ids: dict[str, _Ids] = {}

    def of(self, batch: pd.DataFrame) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray, int]]:
        for lang, texts in batch.groupby("lang", sort=False)["text"]:
            for words, old in word_runs(texts):
                if sum(map(len, self.ids.values())) > WORDS:
                    self.ids.clear()
                if lang not in self.ids:
                    self.ids[lang] = _Ids(lang)
                known = self.ids[lang]
                ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                yield lang, words, ids, np.array(known.hashes, np.uint64), old


def _fill(most: int, min_count: int, bits: int):
    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pages of sketches of the runs' counts."""
        sketch, runs = CountMin(min_count, most, DEPTH, bits), _Runs()
        for batch in batches:
            for _, _, ids, hashes, old in runs.of(batch):
                for k, whole, h in grams(ids, hashes, most):
                    new = max(0, old - k + 1)
                    sketch.add(k - 1, h[new:][whole[new:]])
        yield from sketch.pages()

    return fill


def counted(words: list[bytes], ids: np.ndarray, hashes: np.ndarray, old: int, most: int, may) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(k, phrases, counts) of the runs of k words that may(k, hashes) lets pass, and their parts too.

    A run's number is that of its beginning and of its last word together, so equal
    numbers are equal words, and no hash decides what is counted as one.
    """
    number, passed = ids, None
    for k, whole, h in grams(ids, hashes, most):
        ok = whole.copy()
        if k > 1:
            ok &= passed[:-1] & passed[1:]
        at = np.flatnonzero(ok)
        at = at[may(k - 1, h[at])]
        passed = np.zeros(len(ok), bool)
        passed[at] = True
        code = number[at] if k == 1 else number[at] * len(hashes) + ids[at + k - 1]
        _, first, inverse = np.unique(code, return_index=True, return_inverse=True)
        number = np.zeros(len(ok), np.int64)
        number[at] = inverse
        counts = np.bincount(inverse[at > old - k], minlength=len(first))
        new = np.flatnonzero(counts)
        yield k, [b" ".join(words[s : s + k]) for s in at[first[new]].tolist()], counts[new]


def _count(reached, most: int, step: int = 10_000):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(lang, k, phrase, f) of what the sketches let pass; k = 0 has the number of all words."""
        runs, held = _Runs(), {}

        def told() -> Iterator[pd.DataFrame]:
            for (lang, k), found in held.items():
                rows = list(found.items())
                for at in range(0, len(rows), step):
                    yield pd.DataFrame(rows[at : at + step], columns=["phrase", "f"]).assign(lang=lang, k=k)[["lang", "k", "phrase", "f"]]
            held.clear()

        for batch in batches:
            for lang, words, ids, hashes, old in runs.of(batch):
                held.setdefault((lang, 0), Counter())[b""] += int((ids[old:] > 0).sum())
                for k, phrases, counts in counted(words, ids, hashes, old, most, reached.value):
                    into = held.setdefault((lang, k), Counter())
                    for phrase, n in zip(phrases, counts.tolist(), strict=True):
                        into[phrase] += n
                if sum(map(len, held.values())) > HELD:
                    yield from told()
        yield from told()

    return count


def frequent(docs: DataFrame, min_count: int = MIN_COUNT, most: int = MOST, bits: int = BITS) -> DataFrame:
    """(lang, k, phrase, f) of rows (lang, text): all phrases of 1 to `most` words with f >= min_count; k = 0 has the number of words."""
    rows = gathered(docs.select("lang", F.col("text").cast("binary").alias("text")))
    pages = rows.mapInPandas(_fill(most, min_count, bits), PAGES)
    reached = docs.sparkSession.sparkContext.broadcast(merge(pages, min_count, most, DEPTH, bits))
    told = rows.mapInPandas(_count(reached, most), "lang string, k int, phrase binary, f long")
    return materialize(told.groupBy("lang", "k", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("f").alias("f")).where((F.col("f") >= min_count) | (F.col("k") == 0)))


def _joined(words: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(words, start, n), " ")


def _score(a: Column, parts: Column) -> Column:
    """floor(2000000 * a / parts), exact: in 64 bits where they hold the product, and in decimals beyond."""
    by = 2_000_000
    wide = F.call_function("div", a.cast("decimal(20,0)") * F.lit(by).cast("decimal(10,0)"), parts.cast("decimal(20,0)"))
    return F.when(a < (1 << 63) // by, F.call_function("div", a * F.lit(by).cast("long"), parts)).otherwise(wide)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", *, min_count: int = MIN_COUNT, most: int = MOST, top: int = TOP, subsumed: tuple[int, int] = SUBSUMED, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of 2 to `most` (at most 4) words of each language.

    a is the phrase's count, at least min_count, l and r those of its two parts at the
    cut of the lowest score, n that of all words. A null language is "und", and a null
    text empty. Words are never joined over the end of a piece or of a text; repeats and
    overlaps count each. Phrases of equal score go by their count, then by UTF-8. A
    language without a frequent phrase has no row, and an empty table none at all; other
    columns aren't read. Texts of any length are taken whole, in runs of SLICE bytes.

    A task holds a batch's texts, WORDS words, HELD phrases, and 2**bits cells for
    each length and row. A sketch keeps out what is rarer than about a language's runs /
    2**bits; beyond 2**bits * min_count runs it lets much pass, and more is shuffled,
    but no result changes. So min_count should grow with the corpus.
    """
    if not LEAST <= most <= MOST:
        raise ValueError(f"phrases have {LEAST} to {MOST} words")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    freq = frequent(rows, min_count, most, bits)
    words, k, a = F.split("phrase", " "), F.col("k"), F.col("a")
    known = lean(freq.where("k > 0").select("lang", F.col("phrase").alias("part"), "f"))
    cand = freq.where(k >= LEAST).select("lang", "k", "phrase", F.col("f").alias("a"))
    cuts = cand.select("lang", "phrase", "a", words.alias("w"), "k", F.explode(F.sequence(F.lit(1), k - 1)).alias("cut"))
    cuts = cuts.select("lang", "phrase", "a", "cut", _joined(F.col("w"), F.lit(1), F.col("cut")).alias("left"), _joined(F.col("w"), F.col("cut") + 1, k - F.col("cut")).alias("right"))
    part = lambda name, c: known.select("lang", F.col("part").alias(name), F.col("f").alias(c))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    worst = F.min(F.struct(_score(a, F.col("l") + F.col("r")).alias("score"), "cut", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(worst.alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    inner = F.flatten(F.transform(F.sequence(F.lit(LEAST), k - 1), lambda m: F.transform(F.sequence(F.lit(1), k - m + 1), lambda s: _joined(words, s, m))))
    longer = cand.where(k > LEAST).select("lang", F.explode(inner).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    share, of = subsumed
    stays = F.col("longer").isNull() | (F.col("longer").cast("decimal(20,0)") * of < a.cast("decimal(20,0)") * share)
    left = scored.join(longer, ["lang", "phrase"], "left").where(stays)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    total = freq.where("k = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
with d as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from d),
g as (
  select lang, k, list_slice(w, s + 1, s + k) as w
  from (select lang, w, k, unnest(range(len(w) - k + 1)) as s from p, (values (1), (2), (3), (4)) ks(k) where len(w) >= k) x),
f as (select lang, k, array_to_string(w, ' ') as phrase, count(*)::bigint as f from g group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
cand as (select lang, k, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 30),
cuts as (select *, unnest(range(1, k)) as c from cand),
scored as (
  select cuts.lang, cuts.k, cuts.phrase, a, c, x.f as l, y.f as r, ((2000000::hugeint * a) // (x.f + y.f)::hugeint)::bigint as score
  from cuts join f x on x.lang = cuts.lang and x.k = c and x.phrase = array_to_string(list_slice(w, 1, c), ' ')
    join f y on y.lang = cuts.lang and y.k = cuts.k - c and y.phrase = array_to_string(list_slice(w, c + 1, cuts.k), ' ')),
worst as (select lang, phrase, a, arg_min(l, (score, c)) as l, arg_min(r, (score, c)) as r, min(score) as score from scored group by all),
inner_ as (
  select lang, array_to_string(list_slice(w, s + 1, s + m), ' ') as phrase, max(a) as longer
  from (select lang, w, a, m, unnest(range(k - m + 1)) as s from cand, (values (2), (3)) ms(m) where m < k) x group by all),
stays as (
  select worst.*, n from worst join n using (lang) left join inner_ using (lang, phrase)
  where longer is null or 100 * longer < 80 * a)
select * from (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score from stays) x where rank <= 2000
"""
