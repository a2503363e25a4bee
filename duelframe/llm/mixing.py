"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source's documents, in an order that a hash permutes, form a line of words; the
line is repeated until the source's target is met, and cut in blocks. The blocks of
all sources are then dealt to the output shards: a node of a binary tree of shards
splits its exact quota of each source's blocks between its two halves as a draw
without replacement would, a multivariate hypergeometric draw, down to the shards.
A shard takes its quota of each source from a keyed pseudo-random permutation of the
source's blocks, so shards never share a block, and orders what it has by a hash.

Sources are a table like any other: their targets are found by aggregates, and the
splitting tree runs in tasks, for groups of sources whose totals were split before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duelframe.llm.common import WORD, lean, materialize, table, text_hash

BLOCK_WORDS = 1024
#: Weights of the sources by code point, null last, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST_PASSES = 1.5, 2.0
#: Sources of a group; a group's quotas are split in one task.
GROUP = 1024
#: Rounds of the permutation of blocks.
ROUNDS = 32


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(id_: Column, seed: int) -> Column:
    """The key that documents of a source are ordered by: the MD5 of id and seed."""
    return F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(f":{seed}")))


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many good ones there are among so many draws without replacement.

    By inversion, at any size: the probabilities follow from their exact ratios, up to
    12 standard deviations and 20 from the mode, beyond which they don't reach a
    double's precision.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    n = good + bad
    deviation = math.sqrt(draws / n * good / n * bad * (n - draws) / max(1, n - 1))
    mode, reach = (draws + 1) * (good + 1) // (n + 2), int(12 * deviation) + 20
    low, high = max(low, mode - reach), min(high, mode + reach)
    x = np.arange(high - low, dtype=float)  # from low, so that differences are exact
    steps = np.log(good - low - x) + np.log(draws - low - x) - np.log(low + 1 + x) - np.log(bad - draws + low + 1 + x)
    logs = np.concatenate(([0.0], np.cumsum(steps)))
    sums = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(sums, rng.random() * sums[-1], side="right").clip(0, high - low))


def even(total: int, shards: int) -> list[int]:
    """A total dealt to shards by halves, as evenly as can be."""
    if shards == 1:
        return [total]
    half = shards // 2
    n = total * half // shards
    return even(n, half) + even(total - n, shards - half)


def split_quotas(quotas: Sequence[int], sizes: Sequence[int], rng: np.random.Generator) -> np.ndarray:
    """shards x sources: how many blocks of each source a shard gets; columns sum to quotas, rows to sizes."""
    quotas = np.asarray(quotas, np.int64)
    if len(sizes) == 1:
        return quotas[None]
    half = len(sizes) // 2
    draws, rest, left = int(sum(sizes[:half])), int(quotas.sum()), np.zeros_like(quotas)
    for k, q in enumerate(quotas.tolist()):  # conditional draws, source by source
        rest -= q
        left[k] = hypergeometric(rng, q, rest, draws)
        draws -= int(left[k])
    return np.concatenate([split_quotas(left, sizes[:half], rng), split_quotas(quotas - left, sizes[half:], rng)])


def _ranked(stats: DataFrame) -> DataFrame:
    """stats with k, the place of its source by code point, null last; sorted in ranges, each by a task."""
    order = F.col("source").asc_nulls_last()
    spread = materialize(stats.repartitionByRange(max(1, stats.count() // (4 * GROUP)), order).withColumn("range", F.spark_partition_id()))
    sizes = spread.groupBy("range").agg(F.count("*").alias("n"))
    before = sizes.select("range", (F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(order))
    return spread.withColumn("place", place).join(F.broadcast(before), "range").withColumn("k", F.col("before") + F.col("place") - 1).drop("range", "place", "before")


def with_targets(stats: DataFrame, total: float, most: float = MOST_PASSES) -> DataFrame:
    """(words, weight, ...) with target: shares of total by weight, none above most times its words.

    What full ones can't take goes to the rest by weight. Each round finds those that
    are full at the level of the round before; the level only rises, and stays once
    they are the same, after few rounds.
    """
    cap, full, level = F.lit(most) * F.col("words"), None, 0.0
    while True:
        is_full = F.lit(level) * F.col("weight") > cap if full is not None else F.lit(False)
        row = stats.agg(F.count_if(is_full).alias("n"), F.sum(F.when(is_full, cap)).alias("taken"), F.sum(F.when(~is_full, F.col("weight"))).alias("mass")).first()
        left, mass = total - (row.taken or 0.0), row.mass or 0.0
        if row.n == full or not mass:
            break
        full, level = row.n, left / mass
    share = F.lit(left) * F.col("weight") / F.lit(mass) if mass else F.lit(0.0)
    return stats.withColumn("target", F.when(is_full, cap).otherwise(share))


def _permuted_block(block: Column, n: Column, key: Column) -> Column:
    """The place of a block among n, by the keyed permutation of swaps or not (Hoang, Morris and Rogaway 2012).

    In each round a place is paired with another, and a hash of the larger of the two
    decides for both whether they are swapped; so every round is a permutation.
    """

    def swapped(x: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(key, r) - x, n)
        return F.when(F.xxhash64(key, r, F.greatest(x, other)).bitwiseAND(F.lit(1).cast("long")) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.pmod(block, n), swapped)


def _plan(rows: DataFrame, weights: Mapping[str | None, float] | Sequence[float], share: float, most_passes: float, shards: int, block_words: int, seed: int) -> DataFrame:
    """(k, source, source_size, target, draws, blocks, ends) of each source; ends are its quotas' running sums over the shards."""
    spark = rows.sparkSession
    stats = materialize(rows.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    ranked = _ranked(stats)
    if isinstance(weights, Mapping):
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "name string, weight double")
        ranked = ranked.join(F.broadcast(given), F.col("source").eqNullSafe(F.col("name")), "left").drop("name").fillna(0.0, ["weight"])
    else:
        ranked = ranked.withColumn("weight", F.array(*[F.lit(float(w)) for w in weights])[F.pmod("k", F.lit(len(weights))).cast("int")])
    ranked = materialize(ranked)
    sums = ranked.agg(F.sum("n").alias("n"), F.sum("words").alias("words"), F.max("k").alias("k")).first()
    draws = F.least(F.floor(F.col("target") + 0.5), F.floor(F.lit(most_passes) * F.col("words")))
    goals = with_targets(ranked, share * (sums.words or 0), most_passes).withColumn("draws", draws).withColumn("blocks", F.ceil(F.col("draws") / block_words))
    goals = materialize(goals.withColumn("group", F.floor(F.col("k") / GROUP)))
    groups = goals.groupBy("group").agg(F.sum("blocks").alias("blocks")).orderBy("group").collect()
    sizes = even(sum(r.blocks for r in groups), shards)
    shares = split_quotas([r.blocks for r in groups], sizes, np.random.default_rng(seed)) if groups else np.zeros((shards, 0), np.int64)
    dealt = spark.createDataFrame([(r.group, shares[:, g].tolist()) for g, r in enumerate(groups)], "group long, shares array<long>")

    def deal(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("k")
        quotas = split_quotas(group["blocks"].to_numpy(), group["shares"].iloc[0].tolist(), np.random.default_rng([seed, int(group["group"].iloc[0])]))
        return pd.DataFrame({"k": group["k"].to_numpy(), "ends": list(np.cumsum(quotas, axis=0).T)})

    ends = goals.select("group", "k", "blocks").join(F.broadcast(dealt), "group").groupBy("group").applyInPandas(deal, "k long, ends array<long>")
    return materialize(goals.join(ends, "k").select("k", "source", F.col("words").alias("source_size"), "target", "draws", F.greatest(F.col("blocks"), F.lit(1)).alias("blocks"), "ends"))


def _in_line(rows: DataFrame) -> DataFrame:
    """(k, id, size, t, at): where each row's words begin in the line of its source, in the order of h, id, size and t.

    Rows are dealt to ranges of that order, with a number for each row as its last key:
    so rows of one id, of no id or equal in everything make no range longer. Sizes add up
    within a range, and the ranges' sums give where each begins.
    """
    order = ["k", "h", "id", "size", "t", "copy"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            k, size = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("k", "size"))
            begins = np.flatnonzero(np.concatenate(([k[0] != last], k[1:] != k[:-1])))
            before = np.cumsum(size) - size
            offset = np.full(len(k), total, np.int64)
            for a, b in zip(begins, [*begins[1:], len(k)]):
                offset[a:b] = -before[a]
            at = before + offset
            last, total = k[-1], int(at[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], [*batch.schema.names, "inside"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("k", "id", "size", "t").withColumn("range", F.spark_partition_id())
    kinds = ", ".join(f"{c} {kind}" for c, kind in dealt.dtypes)
    summed = materialize(dealt.mapInArrow(add_up, f"{kinds}, inside long"))
    sums = summed.groupBy("k", "range").agg(F.sum("size").alias("words"))
    before = lean(sums.select("k", "range", F.expr("sum(words) over (partition by k order by range rows between unbounded preceding and current row) - words").alias("before")))
    return summed.join(before, ["k", "range"]).select("k", "id", "size", "t", (F.col("before") + F.col("inside")).alias("at"))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | Sequence[float] = WEIGHTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, share: float = SHARE, most_passes: float = MOST_PASSES, shards: int = 64, block_words: int = BLOCK_WORDS, seed: int = 2) -> DataFrame:
    """(id, source, size, source_size, target, taken, pieces) for each row of docs.

    size counts the text's words, 0 for a null or empty one. weights are by source,
    or repeat along the sources in code-point order with null last, which is a
    source like any other. pieces are the (shard, place, block, offset, pass, start,
    words) that the mix takes: words from the start-th of the document go to a shard,
    at an offset in a block that has a place in the shard's shuffled order. taken is
    their words' sum; a source's sum is its target rounded. An empty table gives an
    empty result; rows of no words have no pieces. A repeated row is a document of its
    own. The same rows give the same mix.

    The driver receives totals of groups of GROUP sources; rows are put in line in
    ranges of even size, so a source or an id that most rows have is spread over many tasks.
    """
    return _mix(docs, weights, id_col, text_col, source_col, share, most_passes, shards, block_words, seed).drop("k", "t")


def _mix(docs: DataFrame, weights, id_col: str, text_col: str, source_col: str, share: float, most_passes: float, shards: int, block_words: int, seed: int) -> DataFrame:
    """mix with k, the source's place, and t, a hash of the text."""
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), n_words(F.col(text_col)).alias("size"), text_hash(F.col(text_col), 2).alias("t")).withColumn("h", permuted(F.col("id"), seed)).withColumn("copy", F.monotonically_increasing_id()))
    plan = _plan(rows, weights, share, most_passes, shards, block_words, seed)
    few = lean(plan.select("k", F.col("source").alias("name")))
    keyed = rows.join(few, rows["source"].eqNullSafe(few["name"])).select("k", "id", "size", "t", "h", "copy")
    line = _in_line(keyed)
    full = line.join(lean(plan, 1 << 14), "k")

    passes = F.sequence(F.lit(0), F.lit(math.ceil(most_passes) - 1))

    def of_pass(p: Column) -> Column:
        first = F.col("at") + p * F.col("source_size")
        last = F.least(first + F.col("size"), F.col("draws"))  # past the last word

        def of_block(b: Column) -> Column:
            start = F.greatest(first, b * block_words)
            return F.struct(p.cast("int").alias("pass"), b.alias("block"), (start - b * block_words).alias("offset"), (start - first).alias("start"), (F.least(last, (b + 1) * block_words) - start).alias("words"))

        return F.when((F.col("size") > 0) & (last > first), F.transform(F.sequence(F.floor(first / block_words), F.floor((last - 1) / block_words)), of_block)).otherwise(F.array())

    def turned(x: Column) -> Column:  # once for each piece, before the places are looked up among all ends
        return F.struct(x.alias("x"), _permuted_block(x["block"], F.col("blocks"), F.xxhash64("k", F.lit(seed))).alias("at"))

    def placed(y: Column) -> Column:
        x, shard = y["x"], F.size(F.filter("ends", lambda end: end <= y["at"]))
        return F.struct(shard.alias("shard"), F.xxhash64("k", x["block"], F.lit(seed)).alias("place"), x["block"].alias("block"), x["offset"].alias("offset"), x["pass"].alias("pass"), x["start"].alias("start"), x["words"].alias("words"))

    pieces = F.transform(F.transform(F.flatten(F.transform(passes, of_pass)), turned), placed)
    out = full.select(F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target", "k", "t", pieces.alias("pieces"))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, x: n + x["words"])
    return out.select(id_col, source_col, "size", "source_size", "target", taken.alias("taken"), "pieces", "k", "t")


def draw_shards(docs: DataFrame, weights: Mapping[str | None, float] | Sequence[float] = WEIGHTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, share: float = SHARE, most_passes: float = MOST_PASSES, shards: int = 64, block_words: int = BLOCK_WORDS, seed: int = 2) -> DataFrame:
    """(shard, place, source, block, offset, id, pass, start, words, text): the mix itself, in the order of its shards.

    Rows are dealt by ranges of shard and place and sorted within, so that a writer's
    files follow each other and a large shard is several tasks. Blocks come in their
    shuffled places, the words of a block in their line's order; a row's text is the
    piece of the document, its words joined by spaces.
    """
    mixed = _mix(docs, weights, id_col, text_col, source_col, share, most_passes, shards, block_words, seed)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("whole"), text_hash(F.col(text_col), 2).alias("t")).where("whole is not null").dropDuplicates(["id", "t"])
    taken = mixed.where("taken > 0").select(F.col(id_col).alias("own"), F.col(source_col).alias("source"), F.col("t").alias("own_t"), "pieces")
    cut = taken.join(texts, F.col("own").eqNullSafe(F.col("id")) & (F.col("own_t") == F.col("t"))).select("id", "source", "pieces", F.regexp_extract_all("whole", F.lit(WORD), F.lit(0)).alias("all"))
    words = lambda p: F.array_join(F.slice("all", (p["start"] + 1).cast("int"), p["words"].cast("int")), " ")
    piece = cut.select("id", "source", F.explode(F.transform("pieces", lambda p: F.struct(p.alias("p"), words(p).alias("text")))).alias("x"))
    out = piece.select("x.p.shard", "x.p.place", "source", "x.p.block", "x.p.offset", F.col("id").alias(id_col), "x.p.pass", "x.p.start", "x.p.words", "x.text")
    return out.repartitionByRange("shard", "place", "source", "block", "offset").sortWithinPartitions("shard", "place", "source", "block", "offset")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size, md5(coalesce(cast(doc_id as varchar), '') || ':2') as h from documents),
s as (select source, sum(size)::bigint as words from d group by source),
w as (select *, [3.0, 1.0, 2.0][1 + ((row_number() over (order by source nulls last) - 1) % 3)::int]::double as weight from s),
r as (
  select *, 1.5 * sum(words) over () - coalesce(sum(2.0 * words) over (order by 2.0 * words / weight, source rows between unbounded preceding and 1 preceding), 0) as rest,
    sum(weight) over (order by 2.0 * words / weight, source rows between current row and unbounded following) as mass from w),
-- in the order of size by weight, sources are full up to the first that its share of the rest fits in
f as (select rest::double as rest, mass::double as mass from r where rest::double * weight / mass::double <= 2.0 * words order by 2.0 * words / weight, source limit 1),
t as (select w.*, least(2.0 * words, coalesce((select rest from f) * weight / (select mass from f), 2.0 * words))::double as target from w),
line as (
  select doc_id, d.source, size, words, target, least(floor(target + 0.5), 2 * words)::bigint as draws,
    (sum(size) over (partition by d.source order by h, doc_id, size rows between unbounded preceding and current row) - size)::bigint as pos
  from d join t on d.source is not distinct from t.source)
select doc_id, size, words as source_size, target, source,
  (greatest(0, least(size, draws - pos)) + greatest(0, least(size, draws - words - pos)))::bigint as taken
from line
"""
