"""Benchmark decontamination by greedy string tiling.

A document that holds most of a benchmark item's tokens in common passages leaks the
item, in whatever order the passages come (Wise 1993, "String Similarity via Greedy
String Tiling and Running Karp-Rabin Matching"). Windows of MIN_TILE tokens are the
seeds: the items' windows are a table of hashes, and documents join it by theirs. For
every document and item that share one, the longest common passage of tokens not yet
marked is marked, again and again, until none of MIN_TILE tokens is left. The share of
the item's tokens that are marked is its coverage.

Two things keep the join small, and neither loses a pair. A bitmap of the items'
windows, of a bounded size, is broadcast; documents without enough windows in it end
there, and no more than the others' hashes is shuffled. And an item takes part with its
rare windows only: its most frequent ones may be left out as long as they cover less of
it than the coverage asked for, since a document that covers the item then has one of
the others.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.common import lean, materialize, table, text_hash, unused

#: Characters of scripts that are written without spaces; each is a token.
UNSPACED = "฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff"
MIN_TILE = 5
COVERAGE = 0.8
#: Bits of the bitmap for each window of the benchmark, and the most bits in all, as powers of two (32 MB).
BITS_EACH, MOST_BITS = 5, 28
#: Bytes of items' texts that meet a document's text in one row; more items make more rows.
ROW_BYTES = 16 << 10
#: Hashes of tokens that a task remembers.
HELD = 50_000
_TOKEN = re.compile(r"[^\W_]+")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_BOTH = re.compile(rf"[^\W_{UNSPACED}]+|(?=[^\W_])[{UNSPACED}]")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PAGE = 16


def tokens(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits; of scripts without spaces, each character."""
    if not text:
        return []
    text = text.lower()
    return _BOTH.findall(text) if not text.isascii() and _UNSPACED.search(text) else _TOKEN.findall(text)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > HELD:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes of all windows of k tokens, modulo 2**64; k is part of the hash."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * _BASE + hashes[j : j + n]
    return out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return edges[::2], edges[1::2]


class _Side:
    """Tokens as numbers, 0 for one that the other side hasn't, with prefix sums for hashes of windows of any length."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.free = ids, ids > 0
        mixed = ids.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
        up, self.back = (np.cumprod(np.full(len(ids), x, np.uint64), dtype=np.uint64) for x in (_BASE, _BACK))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * up, dtype=np.uint64)))

    def longest(self) -> int:
        a, b = _runs(self.free)
        return int((b - a).max()) if len(a) else 0

    def windows(self, s: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where s free tokens begin, and their hashes."""
        taken = np.concatenate(([0], np.cumsum(~self.free)))
        at = np.flatnonzero(taken[s:] == taken[:-s])
        return at, (self.sums[at + s] - self.sums[at]) * self.back[at]


def tile(doc: np.ndarray, item: np.ndarray, least: int = MIN_TILE) -> list[tuple[int, int, int]]:
    """(start in doc, start in item, length) of the greedy tiles of two arrays of token numbers from 1; 0 matches nothing.

    The longest match comes first; among equally long ones that which starts first
    in the document, then in the item. For each length that a tile has, Karp-Rabin
    hashes of all windows of this length give the places where both agree, which are
    compared before they are marked. Memory is linear in both lengths, and the rounds
    are as many as lengths of tiles.
    """
    if not len(item) or not len(doc):
        return []
    both = np.zeros(int(max(doc.max(), item.max())) + 1, bool)
    both[item] = True
    both[0] = False
    starts, ends = _runs(both[doc])  # of the document only runs of the item's tokens can match
    long = ends - starts >= least
    if not long.any():
        return []
    where = np.concatenate([np.append(np.arange(a, b), -1) for a, b in zip(starts[long], ends[long], strict=True)])
    d, i = _Side(np.where(where >= 0, doc[where], 0)), _Side(item)
    tiles, most = [], min(d.longest(), i.longest())
    while most >= least:
        low, high = least - 1, most
        while low < high:  # the longest match: where s tokens agree, s - 1 do
            s = (low + high + 1) // 2
            found = np.isin(i.windows(s)[1], d.windows(s)[1]).any()
            low, high = (s, high) if found else (low, s - 1)
        if low < least:
            break
        (d_at, d_hash), (i_at, i_hash) = d.windows(low), i.windows(low)
        queues = defaultdict(list)
        for q, h in zip(i_at.tolist()[::-1], i_hash.tolist()[::-1], strict=True):
            queues[h].append(q)
        shared = np.isin(d_hash, i_hash)
        end = 0
        for p, h in zip(d_at[shared].tolist(), d_hash[shared].tolist(), strict=True):
            queue = queues[h]
            while p >= end and queue:
                q = queue[-1]
                if not i.free[q : q + low].all():
                    queue.pop()  # marks stay, so it is taken for good
                elif not np.array_equal(d.ids[p : p + low], i.ids[q : q + low]):
                    break
                else:
                    tiles.append((int(where[p]), q, low))
                    d.free[p : p + low] = i.free[q : q + low] = False
                    end = p + low
        most = low - 1
    return tiles


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, t, n, k, windows): tokens, length of windows, and the windows' hashes in order, of each item that has a token."""
    shape = "n int, k int, windows array<long>"

    @F.pandas_udf(shape)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for texts in batches:
            out = []
            for words in map(tokens, texts):
                k = min(MIN_TILE, len(words))
                out.append((len(words), k, rolling(hashes.of(words), k).view(np.int64) if k else np.zeros(0, np.int64)))
            yield pd.DataFrame(out, columns=["n", "k", "windows"])

    rows = benchmark.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).where("text is not null and item_id is not null").distinct()
    cut_ = rows.select("item_id", "text", F.xxhash64("text").alias("t"), cut.asNondeterministic()("text").alias("c")).select("item_id", "t", "text", "c.n", "c.k", "c.windows")
    return materialize(cut_.where("n > 0"))


def _probes(h: Column, bits: int) -> list[Column]:
    return [F.shiftrightunsigned(h, s).bitwiseAND(F.lit((1 << bits) - 1).cast("long")) for s in (0, 18, 36)]


def _bitmap(seeds: DataFrame, bits: int) -> np.ndarray:
    """Bytes of a bitmap of 2**bits bits with three for each hash; tasks make its pages, of 8 KB."""

    @F.pandas_udf("binary")
    def page(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for places in batch:
                flags = np.zeros(1 << _PAGE, np.uint8)
                flags[places] = 1
                out.append(np.packbits(flags, bitorder="little").tobytes())
            yield pd.Series(out)

    at = seeds.select(F.explode(F.array(*_probes(F.col("hash"), bits))).alias("at"))
    split = at.select(F.shiftright("at", _PAGE).alias("page"), F.col("at").bitwiseAND(F.lit((1 << _PAGE) - 1).cast("long")).cast("int").alias("place"))
    out = np.zeros((1 << bits - _PAGE, 1 << _PAGE - 3), np.uint8)
    for r in split.groupBy("page").agg(F.collect_set("place").alias("places")).select("page", page("places").alias("bytes")).collect():
        out[r.page] = np.frombuffer(r.bytes, np.uint8)
    return out.reshape(-1)


def _held(rows: DataFrame, items: DataFrame, coverage: float) -> DataFrame | None:
    """The rows whose text has windows of the benchmark for as many tokens as the least item needs, with their hashes in hits.

    Some may be chance hits of the bitmap. None if no item has a token.
    """
    seeds = items.select(F.explode("windows").alias("hash")).distinct()
    info = items.agg(F.collect_set("k").alias("ks"), F.min(F.ceil(F.lit(coverage) * F.col("n") - 1e-9)).alias("least")).first()
    if not info.ks:
        return None
    bits = min(MOST_BITS, max(_PAGE, math.ceil(math.log2(seeds.count())) + BITS_EACH))
    held = rows.sparkSession.sparkContext.broadcast(_bitmap(seeds, bits))
    ks, least, mask = sorted(info.ks), info.least, np.uint64((1 << bits) - 1)

    def known(h: np.ndarray) -> np.ndarray:
        found = np.ones(len(h), bool)
        for s in (0, 18, 36):
            at = (h >> np.uint64(s)) & mask
            found &= (held.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        return found

    @F.pandas_udf("array<long>")
    def probe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = _Hashes()
        for texts in batches:
            out = []
            for words in map(tokens, texts):
                x, got, covered = hashes.of(words), [], np.zeros(len(words) + 1, np.int64)
                for k in ks:
                    h = rolling(x, k)
                    at = np.flatnonzero(known(h))
                    if len(at):
                        got.append(h[at])
                        covered[at] += 1
                        covered[at + k] -= 1
                enough = got and (np.cumsum(covered) > 0).sum() >= least
                out.append(np.unique(np.concatenate(got)).view(np.int64) if enough else None)
            yield pd.Series(out, dtype=object)

    return materialize(rows.withColumn("hits", probe.asNondeterministic()("text")).where("hits is not null"))


def _rare(items: DataFrame, hits: DataFrame, coverage: float) -> DataFrame:
    """(hash, item_id, t): the windows by which an item is looked for, its rare ones.

    Of the windows that some text has, the most frequent ones are left out as long as
    together they cover less of the item than `coverage`. An item of which all texts
    together have too little has none.
    """
    freq = hits.groupBy("hash").agg(F.count("*").alias("freq"))
    seeds = items.select("item_id", "t", "n", "k", F.posexplode("windows").alias("q", "hash")).join(freq, "hash")
    whole = seeds.groupBy("item_id", "t", "n", "k").agg(F.sort_array(F.collect_list(F.struct("freq", "hash", "q")), asc=False).alias("w"))

    @F.pandas_udf("array<long>")
    def pick(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for ns, ks, hashes, places in batches:
            out = []
            for n, k, hs, qs in zip(ns, ks, hashes, places, strict=True):
                covered, rare, most = np.zeros(n, bool), set(), 0
                for h, q in zip(hs.tolist(), qs.tolist(), strict=True):
                    if not rare:
                        most += k - int(covered[q : q + k].sum())
                        covered[q : q + k] = True
                    if most >= coverage * n - 1e-9:
                        rare.add(h)
                out.append(sorted(rare))
            yield pd.Series(out, dtype=object)

    w = F.col("w")
    return whole.select("item_id", "t", F.explode(pick("n", "k", w["hash"], w["q"])).alias("hash"))


def _covering(rows: DataFrame, benchmark: DataFrame, item_col: str, text_col: str, coverage: float) -> DataFrame | None:
    """(id, a, b, item_id, coverage, tiles, matched_tokens, item_tokens) of rows (id, a, b, text) that cover an item."""
    items = _items(benchmark, item_col, text_col)
    held = _held(rows, items, coverage)
    if held is None:
        return None
    hits = materialize(held.select("a", "b", F.explode("hits").alias("hash")).distinct())
    pairs = hits.join(_rare(items, hits, coverage), "hash").select("a", "b", "item_id", "t").distinct()
    told = pairs.join(items.select("item_id", "t", "text"), ["item_id", "t"])
    rows_ = F.ceil(F.sum(F.octet_length("text")).over(Window.partitionBy("a", "b")) / F.lit(ROW_BYTES))
    dealt = told.withColumn("rows", rows_).withColumn("row", F.pmod(F.xxhash64("item_id", "t"), "rows"))
    asked = materialize(dealt.groupBy("a", "b", "row").agg(F.collect_list(F.struct("item_id", "text")).alias("items")))

    @F.pandas_udf("array<struct<at int, tiles int, matched_tokens int, item_tokens int>>")
    def tiles(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for texts, asked_ in batches:
            out = []
            for text, others in zip(texts, asked_, strict=True):
                vocabulary: dict[str, int] = {}
                ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in tokens(text)], np.int64)
                found = []
                for at, other in enumerate(others):
                    item = np.array([vocabulary.get(w, 0) for w in tokens(other)], np.int64)
                    if (item > 0).sum() < coverage * len(item) - 1e-9:
                        continue
                    got = tile(ids, item, min(MIN_TILE, len(item)))
                    matched = sum(n for *_, n in got)
                    if matched >= coverage * len(item) - 1e-9:
                        found.append((at, len(got), matched, len(item)))
                out.append(found)
            yield pd.Series(out, dtype=object)

    met = held.drop("hits").join(asked, ["a", "b"])
    found = met.select("id", "a", "b", "items", F.explode(tiles("text", F.col("items")["text"])).alias("x"))
    return found.select("id", "a", "b", F.col("items")[F.col("x.at")]["item_id"].alias("item_id"), (F.col("x.matched_tokens") / F.col("x.item_tokens")).alias("coverage"), "x.tiles", "x.matched_tokens", "x.item_tokens")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, coverage: float = COVERAGE) -> DataFrame:
    """(id, item_id, coverage, tiles, matched_tokens, item_tokens) for every document and item it covers.

    Tokens are lower-cased runs of letters and digits, and single characters of
    scripts without spaces. An item of fewer than MIN_TILE tokens is covered by a text
    that holds it whole. Null and empty texts, and items without tokens or an id,
    neither cover nor are covered. A repeated document comes back as often as it is; a
    repeated item counts once, items that share an id but not the text count each.
    Empty tables give an empty result; columns not named aren't read. Neither table
    passes through the driver.
    """
    rows = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col), 1).alias("a"), text_hash(F.col(text_col), 2).alias("b"), F.col(text_col).alias("text"))
    found = _covering(rows, benchmark, item_col, item_text_col, coverage)
    if found is None:
        kinds = rows.schema["id"].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"`{id_col}` {kinds[0]}, item_id {kinds[1]}, coverage double, tiles int, matched_tokens int, item_tokens int")
    return found.drop("a", "b").withColumnRenamed("id", id_col)


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", *, coverage: float = COVERAGE) -> DataFrame:
    """docs that cover no benchmark item; the rule looks at each row's own text, so ids may be null or repeat."""
    rows = docs.select(F.lit(0).alias("id"), text_hash(F.col(text_col), 1).alias("a"), text_hash(F.col(text_col), 2).alias("b"), F.col(text_col).alias("text"))
    found = _covering(rows, benchmark, item_col, item_text_col, coverage)
    if found is None:
        return docs
    a, b = unused(docs, "a"), unused(docs, "b")
    out = lean(found.select(F.col("a").alias(a), F.col("b").alias(b)).distinct())
    return docs.withColumns({a: text_hash(F.col(text_col), 1), b: text_hash(F.col(text_col), 2)}).join(out, [a, b], "left_anti").select(*docs.columns)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
