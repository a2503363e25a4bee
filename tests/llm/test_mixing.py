import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.llm import mixing
from duelframe.llm.common import table

SF = "/root/testdata/sf0.01"


def targets(sizes, weights, total, most=2.0):
    """Shares by weight; whoever is above its limit gets it, and the rest share again."""
    out, open_ = [0.0] * len(sizes), set(range(len(sizes)))
    while open_:
        mass = sum(weights[k] for k in open_)
        full = [k for k in open_ if mass and total * weights[k] / mass > most * sizes[k]]
        if not full:
            for k in open_:
                out[k] = total * weights[k] / mass if mass else 0.0
            break
        for k in full:
            out[k] = most * sizes[k]
            open_.discard(k)
        total -= sum(out[k] for k in full)
    return out


def test_targets(spark):
    rng = np.random.default_rng(1)
    cases = [([100, 100, 100], [3, 1, 2], 450), ([10, 1000], [3, 1], 1515), ([0, 0], [1, 1], 0), ([5, 7], [0, 0], 18), ([5, 700], [1, 0], 1000)]
    cases += [(rng.integers(0, 10 ** rng.integers(1, 6), 12).tolist(), rng.integers(0, 4, 12).tolist(), None) for _ in range(4)]
    for sizes, weights, total in cases:
        total = 1.5 * sum(sizes) if total is None else total
        frame = spark.createDataFrame([(k, n, float(w)) for k, (n, w) in enumerate(zip(sizes, weights, strict=True))], "k int, words long, weight double").coalesce(1)
        got = [r.target for r in mixing.with_targets(frame, total).orderBy("k").collect()]
        assert got == pytest.approx(targets(sizes, weights, total)), (sizes, weights)


def test_split_is_exact_and_even():
    rng = np.random.default_rng(0)
    quotas = [1000, 7, 0, 350]
    got = mixing.split_quotas(quotas, mixing.even(1357, 13), rng)
    assert got.shape == (13, 4) and (got >= 0).all() and got.sum(0).tolist() == quotas
    assert got.sum(1).tolist() == mixing.even(1357, 13) and got.sum(1).max() - got.sum(1).min() <= 2
    draws = np.array([mixing.split_quotas([30, 70], [50, 50], np.random.default_rng(i))[0, 0] for i in range(2000)])
    assert abs(draws.mean() - 15) < 0.3  # 50 of 100 blocks
    assert abs(draws.var() - 50 * 0.3 * 0.7 * 50 / 99) < 0.6


@pytest.mark.parametrize("n", [3, 40, 10**6, 10**9 - 1, 10**9, 10**9 + 1, 3 * 10**10])
def test_hypergeometric_draws_at_any_size(n):
    rng, good, bad, draws = np.random.default_rng(n), n, 2 * n, n
    got = np.array([mixing.hypergeometric(rng, good, bad, draws) for _ in range(2000 if n < 10**8 else 150)], float)
    mean, var = draws / 3, draws / 3 * 2 / 3 * (2 * n) / (3 * n - 1)
    assert abs(got.mean() - mean) < 4.5 * (var / len(got)) ** 0.5 and 0.6 < got.var() / var < 1.5
    assert got.min() >= 0 and got.max() <= draws


def test_hypergeometric_against_its_definition():
    for good, bad, draws in [(3, 4, 5), (10, 2, 6), (1, 1, 1), (0, 5, 3), (5, 0, 3), (7, 7, 0)]:
        got = Counter(mixing.hypergeometric(np.random.default_rng(i), good, bad, draws) for i in range(4000))
        for k in range(draws + 1):
            p = math.comb(good, k) * math.comb(bad, draws - k) / math.comb(good + bad, draws)
            assert abs(got[k] / 4000 - p) < 0.035


def test_blocks_are_permuted(spark):
    for n in (1, 2, 3, 10, 1000, 4097):
        got = spark.range(n).select(mixing._permuted_block(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("x")).collect()
        places = np.array([r.x for r in got])
        assert sorted(places) == list(range(n))
        if n == 4097:  # neighbours are strangers, and no step repeats
            assert abs(np.corrcoef(places[:-1], places[1:])[0, 1]) < 0.06 and len(set(np.diff(places))) > 2000


def test_many_sources(spark, monkeypatch):
    """Sources of several groups and ranges get the same exact quotas as those of one."""
    monkeypatch.setattr(mixing, "GROUP", 8)
    docs = spark.createDataFrame([(i, "w " * (i % 50 + 1), None if i % 90 == 7 else f"s{i % 90:02}") for i in range(900)], "doc_id long, text string, source string")
    rows = mixing.mix(docs, shards=7, block_words=10).collect()
    size, taken, shard, quota = defaultdict(int), defaultdict(int), Counter(), defaultdict(set)
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        for p in r.pieces:
            shard[p.shard] += p.words
            quota[p.shard].add((r.source, p.block))
    names = sorted(size, key=lambda x: (x is None, x or ""))
    goals = targets([size[k] for k in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5 * sum(size.values()))
    assert len(names) == 90 and all(abs(taken[k] - g) <= 1 for k, g in zip(names, goals, strict=True))
    assert len(set.union(*quota.values())) == sum(map(len, quota.values())) == sum(-(-n // 10) for n in taken.values())
    assert max(map(len, quota.values())) - min(map(len, quota.values())) <= 2


def test_shards_are_shuffled_and_whole(spark):
    docs = table(spark, SF, "documents")
    mixed = mixing.mix(docs, shards=4, block_words=64)
    got = mixing.draw_shards(docs, shards=4, block_words=64)
    rows = got.collect()
    order = [(r.shard, r.place) for r in rows]
    assert order == sorted(order)
    assert sum(r.words for r in rows) == mixed.agg(F.sum("taken")).first()[0]
    text = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", r.text or "") for r in docs.collect()}
    assert all(r.text == " ".join(text[r.doc_id][r.start : r.start + r.words]) for r in rows)
    first = [r.source for r in rows if r.shard == 0]
    assert sum(a != b for a, b in zip(first, first[1:])) > len(set(first)) * 5  # sources alternate


def test_query_keeps_the_contract(spark):
    rows = mixing.op2_source_mixing(spark, SF).collect()
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    size, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        d = docs[r.doc_id]
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", d.text or ""))
        assert 0 <= r.taken <= 2 * r.size
        size[d.source] += r.size
        taken[d.source] += r.taken
    names = sorted(size)
    goals = dict(zip(names, targets([size[k] for k in names], [(3, 1, 2)[i % 3] for i in range(len(names))], 1.5 * sum(size.values())), strict=True))
    for r in rows:
        s = docs[r.doc_id].source
        assert r.source_size == size[s] and r.target == pytest.approx(goals[s])
    for s in names:
        assert abs(taken[s] - goals[s]) <= 1
    again = mixing.op2_source_mixing(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_pieces_tile_the_documents(spark):
    got = mixing.mix(table(spark, SF, "documents"), shards=5, block_words=100).collect()
    blocks = defaultdict(int)
    shard_words = Counter()
    for r in got:
        per_pass = defaultdict(list)
        for p in r.pieces:
            per_pass[p["pass"]].append((p.start, p.words))
            blocks[r.source, p.shard, p.place] += p.words
            shard_words[p.shard] += p.words
        for spans in per_pass.values():
            spans.sort()
            assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
            assert spans[-1][0] + spans[-1][1] <= r.size
    where = defaultdict(set)
    for s, shard, place in blocks:
        where[s, place].add(shard)
    assert all(len(v) == 1 for v in where.values())  # no two shards share a block
    assert max(blocks.values()) <= 100
    assert len(shard_words) == 5 and max(shard_words.values()) < 1.1 * min(shard_words.values())


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", None, "x"), (2, None, "s", "x"), (3, "", "s", "x"), (4, "w " * 50000, "b", "x"), (5, "one two", "b", "x"), (5, "one two", "b", "x"), (None, "p q", "b", "x"), (6, " x y", "b", "x")],
        "doc_id long, text string, source string, k string",
    )
    rows = {}
    for r in mixing.mix(docs).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == 8 and len(rows[5]) == 2
    assert rows[6][0].size == 2 and rows[2][0].taken == rows[3][0].taken == 0 and rows[2][0].target == 0
    assert rows[4][0].taken <= 100000 and rows[1][0].source_size == 3
    assert abs(sum(r.taken for v in rows.values() for r in v if r.source == "b") - rows[4][0].target) <= 1
    assert mixing.mix(docs.limit(0)).count() == 0
    one = mixing.mix(docs.where("doc_id = 1"), {None: 1.0}).collect()
    assert one[0].taken in (4, 5) and one[0].target == 4.5


def test_crowds_of_null_and_repeated_ids_are_spread(spark, monkeypatch):
    """None of eight tasks gets more than a quarter of rows without an id, of one id, or equal in everything."""
    rows = spark.range(60_000).selectExpr("case when id % 3 = 0 then null when id % 3 = 1 then 7 else id end as doc_id", "case when id % 6 = 0 then 'same words here' else concat('a b ', id) end as text", "'s' as source")
    kept, whole = [], mixing.materialize
    monkeypatch.setattr(mixing, "materialize", lambda df: kept.append(whole(df)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        got = mixing.mix(rows)
        assert got.count() == 60_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    ranges = [r["count"] for t in kept if "range" in t.columns and "inside" in t.columns for r in t.groupBy("range").count().collect()]
    assert len(ranges) == 8 and max(ranges) < 15_000 and sum(ranges) == 60_000
    sums = got.agg(F.sum("taken").alias("t"), F.max("target").alias("target"), F.max(F.col("taken") / F.col("size")).alias("most")).first()
    assert abs(sums.t - sums.target) <= 1 and sums.most <= 2
    line = got.select("doc_id", "size", F.size("pieces").alias("n"), "taken")
    assert line.exceptAll(mixing.mix(rows.repartition(5)).select("doc_id", "size", F.size("pieces").alias("n"), "taken")).count() == 0
