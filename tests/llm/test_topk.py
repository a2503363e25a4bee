import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from duelframe.llm import topk
from duelframe.llm.common import table


def brute(rows, k=10):
    """rows of (id, vector) -> sorted (query, rank, id, score); a row is told from others by its place."""
    ok = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (q, v) in enumerate(ok):
        if q is None or q % 100:
            continue
        found = [(-sum(a * b for a, b in zip(v, w)), i is None, i or 0) for other, (i, w) in enumerate(ok) if other != at]
        out += [(q, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def search(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(frame.withColumns({"score": F.lit(1), "uid": F.lit("u"), "x": F.lit(2)}), F.col("vec_id") % 100 == 0, **kw)
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_all_pairs(spark):
    """Clusters, ties, repeated ids and rows, null ids, unusable vectors, other lengths, and negative products."""
    rng = random.Random(11)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    rows = [(k, [x + rng.gauss(0, 0.1) for x in rng.choice(centres)]) for k in range(400)]
    rows += [(500 + k, [0.5] * 6) for k in range(30)] + [(500, [0.5] * 6), (500, [0.5] * 6), (None, [0.5] * 6), (None, [9.0] * 6), (None, [0.5] * 6)]
    rows += [(100, None), (700, [1.0, None]), (800, [math.nan] * 6), (900, [math.inf, 0.0]), (1000, []), (1100, [1.0]), (1200, [-1.0] * 9), (-100, [0.1] * 6)]
    assert search(spark, rows, block=32) == brute(rows)
    assert search(spark, rows[:7], block=2) == brute(rows[:7])  # fewer than ten others
    assert search(spark, rows, block=1000, k=3) == brute(rows, 3)


def test_no_rows_and_no_queries(spark):
    assert search(spark, []) == [] and search(spark, [(1, [1.0]), (None, [2.0])]) == [] and search(spark, [(0, [1.0])]) == []


def test_products_beyond_doubles_and_beyond_64_bits(spark):
    big = [1e5 + 0.25, 3e5, -7e4]
    rows = [(0, big)] + [(k, [x * k + 1 / 1024 for x in big]) for k in range(1, 15)]
    assert search(spark, rows) == brute(rows)
    got = search(spark, [(0, [1e30, 1.0]), (1, [1e30, 0.0]), (2, [-1e30, 0.0]), (3, [0.0, 2.0])])
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 3, 2 << 20), (0, 3, 2, -(2**63) + 2)]


def test_many_groups_of_queries_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BYTES", 8 * 4 * 3)  # three queries at once
    rng = random.Random(3)
    rows = [(100 * k, [1.0, 2.0, 3.0, 4.0]) for k in range(8)] + [(k, [1.0, 2.0, 3.0, 4.0] if k % 3 else [rng.gauss(0, 1) for _ in range(4)]) for k in range(1, 90)]
    assert search(spark, rows, block=16) == brute(rows)


def test_equal_vectors_fill_blocks_evenly(spark):
    frame = spark.range(5000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(2.0)).alias("embedding"))
    blocks = topk.index_blocks(frame, "vec_id", "embedding", F.lit(False), 100)
    assert blocks.agg(F.sum("rows"), F.max("rows")).first() == (5000, 100) and blocks.count() <= 50 + 4


def test_bounds_hold_and_spare_most_blocks():
    """On clusters of vectors no bound is below a score, and few blocks are scored."""
    rng = np.random.default_rng(1)
    x = np.floor(1024 * (rng.normal(size=(64, 32))[np.repeat(np.arange(64), 64)] + 0.05 * rng.normal(size=(4096, 32))))
    made = [next(topk._pack(64)([frame(x, a)])) for a in range(0, 4096, 64)]
    blocks = [topk.Block(next(b.itertuples())) for b in made]
    q = x[::100]
    bound = topk.bounds(q, np.stack([b.high for b in blocks]), np.stack([b.low for b in blocks]))
    assert all((topk.scores(q, b.x).max(axis=1) <= bound[:, k]).all() for k, b in enumerate(blocks))
    best = topk.Best(np.arange(len(q)) * 100, np.full(len(q), topk._LEAST), 10)
    done = topk.visit(best, q, np.arange(len(q)), blocks)
    assert done < 0.1 * len(q) * len(blocks)
    want = np.sort(topk.scores(q, x) + np.where(np.arange(4096)[None] == (np.arange(len(q)) * 100)[:, None], topk._LEAST // 2, 0), axis=1)[:, ::-1][:, :10]
    assert (best.score == want).all()


def frame(x, a):
    return pd.DataFrame({"id": range(a, a + 64), "asks": False, "uid": range(a, a + 64), "x": [v.tobytes() for v in x[a : a + 64]]})


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    d = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in table(spark, d, "embeddings").collect()]
    assert sorted((tuple(r) for r in topk.op11_top_k(spark, d).collect()), key=str) == brute(rows)
