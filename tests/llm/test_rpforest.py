import numpy as np

from duelframe.llm import rpforest

SCHEMA = "vec_id long, embedding array<float>, label int, links string, root int"


def brute(rows, cosine=0.98, kind=np.float32):
    """{id: (links, component)} by all pairs."""
    good = {}
    for i, v, label in rows:
        if v is not None and label is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v):
            x = np.asarray(v, kind).astype(float)
            x /= np.abs(x).max()
            good[i] = (x / np.linalg.norm(x), (label, len(v)))
    ids = sorted(good)
    near = {i: set() for i, *_ in rows}
    for a in ids:
        for b in ids:
            if a < b and good[a][1] == good[b][1] and good[a][0] @ good[b][0] >= cosine:
                near[a].add(b)
                near[b].add(a)
    comp = {i: i for i in near}
    for i in sorted(near):
        if comp[i] == i:
            todo = [i]
            while todo:
                for k in near[todo.pop()]:
                    if comp[k] > i:
                        comp[k] = i
                        todo.append(k)
    return {i: (len(near[i]), comp[i]) for i in near}


def clustered(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 and rows:
            base = np.array(rows[rng.integers(len(rows))][1])
            v = base + rng.normal(0, 0.03, dims) * np.linalg.norm(base) / 2 * (i % 2)
        else:
            v = rng.normal(size=dims)
        rows.append((i, np.float32(v).tolist(), i % 2))
    return rows


def test_recall_and_precision_against_all_pairs(spark):
    rows = clustered(900, 7)
    want = brute(rows)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = {r.vec_id: r for r in rpforest.similar_vectors(frame, leaf=60).collect()}
    assert len(got) == 900 and sum(w[0] for w in want.values()) > 1000
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) > 0.97 * 900
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_dense_cluster_larger_than_a_leaf_is_exact(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(i, np.float32(centre + rng.normal(0, 0.08, 16)).tolist(), 1) for i in range(300)]
    want = brute(rows)
    assert 0 < min(n for n, _ in want.values())
    got = rpforest.similar_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), leaf=40).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want


def test_dense_cluster_of_many_blocks(spark):
    rng = np.random.default_rng(4)
    centre = rng.normal(size=16)
    rows = [(i, np.float32(centre + rng.normal(0, 0.08, 16)).tolist(), 1) for i in range(400)]
    got = rpforest.similar_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), leaf=40, block=37).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == brute(rows)


def test_recall_at_ten_levels_and_more(spark, monkeypatch):
    """Trees of two phases and about ten levels, as for 600 thousand vectors, still find nearly every pair."""
    monkeypatch.setattr(rpforest, "LEVELS", 6)
    rng = np.random.default_rng(11)
    base = rng.normal(size=(2000, 32))
    near = base[rng.permutation(2000)[:800]] * (1 + rng.random((800, 1))) + 0
    near += rng.normal(size=near.shape) * np.linalg.norm(near, axis=1, keepdims=True) * 0.198 / 32**0.5  # cosines just above 0.98
    rows = [(i, np.float32(v).tolist(), 1) for i, v in enumerate(np.concatenate([base, near]))]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    depth = rpforest.grow(frame.selectExpr("cast(vec_id as string) as id", "cast(label as long) as root", "embedding as v"), leaf=5).groupBy("leaf").count()
    leaves = depth.selectExpr("count(*) as n", "count_if(count <= 5) as small", "max(count) as most").first()
    assert leaves.n > 8 * 512 and leaves.small > 0.95 * leaves.n, leaves
    want = sum(n for n, _ in brute(rows).values())
    got = sum(r.n_links for r in rpforest.similar_vectors(frame, leaf=5).collect())
    assert want > 500 and 0.9 * want <= got <= want


def test_ids_with_several_vectors(spark):
    """What any of an id's vectors reaches is one component; its links are those of all of them."""
    rows = [(3, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (4, [0.0, 1.0], 1), (5, [0.0, 1.0], 1), (6, [-1.0, 0.0], 1)]
    got = rpforest.similar_vectors(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == [(3, 1, 3), (4, 1, 3), (5, 2, 3), (5, 2, 3), (6, 0, 6)]


def test_very_large_and_small_components(spark):
    rows = [(1, [1e200, 1e200], 1), (2, [1e200, 1.0001e200], 1), (3, [1e-200, 1e-200], 1), (4, [1e-320, 0.0], 1), (5, [1e308, -1e308], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in rpforest.similar_vectors(frame).collect()}
    assert got == brute(rows, kind=float) and got[2] == (2, 1)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [0.0, 0.0], 1), (3, [1.0, None], 1), (4, [1.0, nan], 1), (5, [inf, 1.0], 1), (6, [], 1), (7, [1.0, 0.0], None),
        (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 1), (11, [1.0, 0.0], 2), (12, [1.0, 0.0, 0.0], 1), (13, [-1.0, 0.0], 1), (20, [1e-30, 0.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in [*rows, (8, [1.0, 0.0], 1), (None, [1.0, 0.0], 1)]], SCHEMA)
    got = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in rpforest.similar_vectors(frame).collect()]
    want = brute(rows)
    assert sorted(got, key=str) == sorted([(i, n, c, i == c) for i, (n, c) in want.items()] + [(8, 3, 8, True), (None, 0, None, False)], key=str)
    assert rpforest.similar_vectors(frame.limit(0)).count() == 0


def test_table_recall(spark):
    from duelframe.llm.common import table

    rng = np.random.default_rng(5)
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, "/root/testdata/sf0.1", "embeddings").collect()]
    for k in range(900):  # the table has no near-duplicates of its own
        _, v, label = rows[k % 150]
        rows.append((100_000 + k, np.float32(np.array(v) + rng.normal(0, 0.015, len(v)) * np.linalg.norm(v)).tolist(), label))
    unit = np.array([v for _, v, _ in rows], np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    labels = np.array([label for *_, label in rows])
    near = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None])
    want = dict(zip([i for i, *_ in rows], (near.sum(1) - 1).tolist(), strict=True))
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = {r.vec_id: r.n_links for r in rpforest.similar_vectors(frame, leaf=64).collect()}
    assert sum(want.values()) > 1000
    assert all(got[i] <= n for i, n in want.items())
    assert sum(got.values()) >= 0.97 * sum(want.values())


def test_query_over_the_whole_table(spark):
    got = rpforest.op7_embedding_near_dedup(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len({r.vec_id for r in got}) == 500
