"""Exact top-k by inner product, a block of vectors at a time.

Vectors are dealt to blocks of near ones, and a block keeps the greatest and the least
value of each component beside its vectors (its forward index). For a query, the greatest
products that a block's components can have add up to a bound of its scores. Blocks are
visited in the order of their bounds, and scored until no bound reaches the k-th score
found so far (block-max pruning, Mallia, Suel and Tonellotto 2024, with signed
components). Every vector is indexed and every bound holds, so results are exact.

Queries begin with the k-th score within their own block, which their vector is in
anyway. They go to all tasks in groups of a bounded size; for each group the blocks are
read once, and nothing but the best scores is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.common import materialize, table

K, SCALE = 10, 1024
BLOCK = 256
#: Vectors, by hash, that the pivots of the blocks' order are fitted on, the most pivots, and rounds of the fit.
SAMPLE, PIVOTS, ROUNDS = 8192, 64, 8
#: Bytes of queries' vectors that tasks are given at once, and queries whose bounds a task holds at once.
QUERY_BYTES, AT_ONCE = 32 << 20, 2048
#: Blocks that are put in order together.
ORDERED = 64
#: Up to here sums of whole numbers are exact in doubles.
_EXACT = float(1 << 53)
_LEAST, _MOST = np.iinfo(np.int64).min + 1, np.iinfo(np.int64).max  # the least is no score, and can be negated

BLOCKS = "rows int, dims int, asking int, ids binary, marks binary, uids binary, x binary, high binary, low binary"
FOUND = "uid long, query long, id long, none boolean, other long, score long"


def _whole(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors as rows of whole numbers, floor(SCALE * x), shorter ones filled with 0."""
    out = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    return np.floor(out * SCALE)


def fit_pivots(x: np.ndarray, pivots: int = PIVOTS, rounds: int = ROUNDS) -> np.ndarray:
    """Means of clusters of the sample, by Lloyd's rounds from evenly chosen rows."""
    if not len(x):
        return x
    means = x[np.linspace(0, len(x) - 1, min(pivots, len(x))).astype(int)]
    for _ in range(rounds):
        near = nearest(x, means)[:, 0]
        means = np.stack([x[near == k].mean(axis=0) if (near == k).any() else m for k, m in enumerate(means)])
    return means


def nearest(x: np.ndarray, means: np.ndarray) -> np.ndarray:
    """The two nearest means of each row; they only set the order of blocks."""
    width = means.shape[1] if means.size else 0
    x = np.pad(x[:, :width], ((0, 0), (0, max(0, width - x.shape[1]))))
    with np.errstate(over="ignore", invalid="ignore"):
        far = np.nan_to_num((means**2).sum(axis=1) - 2 * x @ means.T) if width else np.zeros((len(x), 1))
    first = far.argmin(axis=1)
    far[np.arange(len(x)), first] = np.inf
    return np.stack([first, far.argmin(axis=1)], axis=1)


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; beyond 64 bits the end of their range."""
    width = min(q.shape[1], x.shape[1])
    q, x = q[:, :width], x[:, :width]
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, width) < _EXACT:
        return (q @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    out = whole(q) @ whole(x).T if width else np.zeros((len(q), len(x)), object)
    return np.clip(out, int(_LEAST) + 1, int(_MOST)).astype(np.int64)


def bounds(q: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Queries x blocks: the greatest score that a block's extremes allow; infinite where doubles aren't exact."""
    width = min(q.shape[1], high.shape[1])
    q, high, low = q[:, :width], high[:, :width], low[:, :width]
    most = np.maximum(np.abs(high), np.abs(low)).max(axis=1, initial=0)
    with np.errstate(over="ignore", invalid="ignore"):
        out = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        out[:, np.abs(q).max(initial=0) * most * max(1, width) >= _EXACT] = np.inf
    return out


class Best:
    """The k best of each query so far: by score, then id with nulls last, then the row's number."""

    def __init__(self, uids: np.ndarray, least: np.ndarray, k: int):
        self.uids, self.kth, self.k = uids, least.copy(), k
        self.score = np.full((len(uids), k), _LEAST)
        self.id, self.none, self.uid = np.zeros((len(uids), k), np.int64), np.ones((len(uids), k), bool), np.full((len(uids), k), -1)

    def add(self, at: np.ndarray, got: np.ndarray, ids: np.ndarray, none: np.ndarray, uids: np.ndarray) -> None:
        """Scores of the queries at `at` with a block's vectors; a query never meets its own row."""
        got[self.uids[at][:, None] == uids[None, :]] = _LEAST
        hit = ((got >= self.kth[at][:, None]) & (got > _LEAST)).any(axis=1)
        at, got = at[hit], got[hit]
        if not len(at):
            return
        wide = lambda v: np.broadcast_to(v, got.shape)
        every = [np.concatenate([mine[at], new], axis=1) for mine, new in ((self.score, got), (self.id, wide(ids)), (self.none, wide(none)), (self.uid, wide(uids)))]
        order = np.lexsort((every[3], every[1], every[2], -every[0]), axis=-1)[:, : self.k]
        self.score[at], self.id[at], self.none[at], self.uid[at] = (np.take_along_axis(v, order, axis=1) for v in every)
        self.kth[at] = np.maximum(self.kth[at], self.score[at, -1])


class Block:
    def __init__(self, row):
        shape = (row.rows, row.dims)
        self.x = np.frombuffer(row.x, np.float64 if len(row.x) == 8 * row.rows * row.dims else np.int16).reshape(shape).astype(float)
        self.ids, self.uids = np.frombuffer(row.ids, np.int64), np.frombuffer(row.uids, np.int64)
        marks = np.frombuffer(row.marks, np.uint8)
        self.none, self.asks = (marks & 1).astype(bool), (marks & 2).astype(bool)
        self.high, self.low = np.frombuffer(row.high), np.frombuffer(row.low)


def _pack(block: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows (id, asks, uid, x) in their order -> blocks of `block` of them."""
        rest = None
        for batch in batches:
            rest = batch if rest is None or not len(rest) else pd.concat([rest, batch])
            while len(rest) >= block:
                yield made(rest.iloc[:block])
                rest = rest.iloc[block:]
        if rest is not None and len(rest):
            yield made(rest)

    def made(rows: pd.DataFrame) -> pd.DataFrame:
        vectors = [np.frombuffer(v) for v in rows["x"]]
        x = np.zeros((len(vectors), max(map(len, vectors))))
        for row, v in zip(x, vectors, strict=True):
            row[: len(v)] = v
        small = np.abs(x).max(initial=0) < 1 << 15
        none, asks = rows["id"].isna().to_numpy(), rows["asks"].to_numpy(bool)
        tell = lambda v, kind: np.ascontiguousarray(v, kind).tobytes()
        return pd.DataFrame([(*x.shape, int(asks.sum()), tell([0 if n else int(v) for v, n in zip(rows["id"], none, strict=True)], np.int64), tell(none + 2 * asks, np.uint8), tell(rows["uid"], np.int64), tell(x, np.int16 if small else float), tell(x.max(axis=0), float), tell(x.min(axis=0), float))], columns=[c.split()[0] for c in BLOCKS.split(", ")])

    return pack


def _usable(v: Column) -> Column:
    """Neither null nor with a component that is null or not finite."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * SCALE) == float("inf")))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False))


def index_blocks(vectors: DataFrame, id_col: str, vec_col: str, asks: Column, block: int = BLOCK) -> DataFrame:
    """BLOCKS of the rows whose vector is usable: near ones together, of any number and however many are equal.

    Rows are put in ranges of (nearest pivot, second nearest, id, row), so no pivot and
    no repeated vector makes a range long.
    """
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.coalesce(asks, F.lit(False)).alias("asks"), v.alias("v")).where(_usable(F.col("v")))
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    sample = rows.orderBy(F.xxhash64("v", F.lit(11)), "id").limit(max(PIVOTS, min(SAMPLE, QUERY_BYTES // (8 * width)))).select("v").toPandas()["v"]
    pivots = fit_pivots(_whole([np.asarray(x, float) for x in sample]))

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                given = [np.asarray(x, float) for x in batch["v"]]
                x = _whole(given)
                near = nearest(x, pivots)
                yield batch.drop(columns="v").assign(a=near[:, 0], b=near[:, 1], x=[row[: len(v)].tobytes() for row, v in zip(x, given, strict=True)])

    placed = rows.withColumn("uid", F.monotonically_increasing_id()).mapInPandas(place, "id long, asks boolean, uid long, a int, b int, x binary")
    key = ["a", "b", "id", "uid"]
    return materialize(placed.repartitionByRange(*key).sortWithinPartitions(*key).select("id", "asks", "uid", "x").mapInPandas(_pack(block), BLOCKS))


def _askers(k: int):
    def askers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """(uid, query, x, least) of the queries in each block, least being the k-th score within it."""
        for batch in batches:
            for b in map(Block, batch.itertuples()):
                q = np.flatnonzero(b.asks)
                best = Best(b.uids[q], np.full(len(q), _LEAST), k)
                for at in range(0, len(q), AT_ONCE):
                    some = np.arange(at, min(len(q), at + AT_ONCE))
                    best.add(some, scores(b.x[q[some]], b.x), b.ids, b.none, b.uids)
                yield pd.DataFrame({"uid": best.uids, "query": b.ids[q], "x": [v.tobytes() for v in b.x[q]], "least": best.kth})

    return askers


def visit(best: Best, q: np.ndarray, at: np.ndarray, blocks: list[Block]) -> int:
    """Score the queries at `at` with blocks in the order of their bounds, until these fall below the k-th scores; the number of pairs scored."""
    width = max(len(b.high) for b in blocks)
    high, low = (np.stack([np.pad(getattr(b, c), (0, width - len(b.high))) for b in blocks]) for c in ("high", "low"))
    bound = bounds(q[at], high, low)
    order, alive, done = np.argsort(-bound, axis=1, kind="stable"), np.arange(len(at)), 0
    for r in range(len(blocks)):
        block = order[alive, r]
        ahead = bound[alive, block] >= best.kth[at[alive]]
        alive, block = alive[ahead], block[ahead]
        if not len(alive):
            break
        done += len(alive)
        for k in np.unique(block).tolist():
            mine, b = at[alive[block == k]], blocks[k]
            best.add(mine, scores(q[mine], b.x), b.ids, b.none, b.uids)
    return done


def _searcher(given, k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """FOUND: the best of the blocks of a task."""
        uids, queries, q, least = given.value
        best = Best(uids, least, k)
        for batch in batches:
            for first in range(0, len(batch), ORDERED):
                blocks = [Block(row) for row in batch.iloc[first : first + ORDERED].itertuples()]
                for at in range(0, len(uids), AT_ONCE):
                    visit(best, q, np.arange(at, min(len(uids), at + AT_ONCE)), blocks)
        row, place = np.nonzero(best.score > _LEAST)
        for at in range(0, len(row), 10_000):
            r, c = row[at : at + 10_000], place[at : at + 10_000]
            yield pd.DataFrame({"uid": uids[r], "query": queries[r], "id": best.id[r, c], "none": best.none[r, c], "other": best.uid[r, c], "score": best.score[r, c]})

    return search


def top_k(vectors: DataFrame, asks: Column, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = K, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that asks, the k other rows of the greatest inner product.

    Components count as floor(1024 * x), x in double precision, and scores are exact
    whole numbers; beyond 64 bits they are the end of the range. Ties go to the smaller
    id, null last. Rows whose vector is null, or has a null or non-finite component (or
    one of which 1024 times isn't finite), take no part; components that the shorter of
    two vectors lacks count as 0. A repeated row is a row of its own, so rows that share
    an id may find each other, and queries that share one have k results each. A null
    `asks` is no query; an empty table, or one without queries, gives an empty result;
    other columns aren't read.

    The driver holds at most QUERY_BYTES of queries' vectors, as do tasks; each such
    group reads the blocks once. The pivots are fitted on SAMPLE rows, of no more bytes
    than that unless PIVOTS rows have more, and decide only which vectors share a block.
    """
    spark = vectors.sparkSession
    blocks = index_blocks(vectors, id_col, vec_col, asks, block)
    queries = materialize(blocks.where("asking > 0").mapInPandas(_askers(k), "uid long, query long, x binary, least long"))
    width = blocks.agg(F.max("dims")).first()[0] or 0
    most, rows, found = max(1, QUERY_BYTES // (8 * max(1, width))), queries.toLocalIterator(), []
    while group := list(islice(rows, most)):
        q = np.zeros((len(group), width))
        for row, r in zip(q, group, strict=True):
            v = np.frombuffer(r.x)
            row[: len(v)] = v
        given = spark.sparkContext.broadcast((np.array([r.uid for r in group]), np.array([r.query for r in group]), q, np.array([r.least for r in group])))
        best = Window.partitionBy("uid").orderBy(F.desc("score"), "none", "id", "other")
        out = blocks.mapInPandas(_searcher(given, k), FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found.append(materialize(out.select(F.col("query").alias("query_id"), "rank", F.when(~F.col("none"), F.col("id")).alias("vec_id"), "score")))
        given.unpersist()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")


def op11_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


SQL = """
with v as (
  select row_number() over () as r, vec_id, [floor(1024 * x::double) for x in embedding] as x
  from embeddings
  where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
s as (
  select q.r, q.vec_id as query_id, c.vec_id, list_sum([(z[1] * z[2])::bigint for z in list_zip(q.x, c.x)])::bigint as score
  from v q join v c on q.r <> c.r where q.vec_id % 100 = 0),
k as (select *, row_number() over (partition by r order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from k where rank <= 10
"""
