"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits the vectors of a label at the median of their projection on a random
direction, and each half again, until a node has at most LEAF vectors; vectors near a
split go to both sides (spill). Vectors are compared within leaves, links are verified
by cosine in double precision, and the links of all trees are united.

Trees grow in phases of several levels. A phase fits the splits of each node that is
still too large on a bounded sample of its vectors, and then sends every vector down
all these levels at once, so a vector moves once a phase, not once a level. The cuts
are tables; the driver learns only whether a node is left to split.

A node that spills most of its vectors holds one dense cluster that no direction
parts; it becomes a leaf at any size. Leaves larger than BLOCK are cut in blocks, and
pairs of blocks are compared by tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.common import lean, materialize, scratch, table, unit
from duelframe.llm.components import connected_components

COSINE = 0.98
TREES = 8
LEAF = 1024
#: Of a leaf, what its splits aim at; medians of samples aren't exact.
FILL = 0.6
#: Vectors of a leaf that a task compares with as many others at once.
BLOCK = 4096
#: Half the width of the spill. Linked unit vectors are at most r = sqrt(2 - 2 * cosine)
#: apart, and in d dimensions their projections on a random direction differ by about
#: r / sqrt(d); this is the factor.
SPILL = 0.12
#: A node with more than this share of its vectors within this factor of its cut isn't split.
DENSE, DENSE_WIDTH = 0.15, 0.48
#: Levels of a phase, and vectors of the sample for each node of its last level.
LEVELS, SAMPLE = 8, 64
#: Components of the vectors that a task sends down at once.
GROUP = 1 << 21


def _directions(node: int, tree: int, levels: int, dims: int) -> np.ndarray:
    """dims x levels: a random unit vector for each level of a node's subtree, times the root of the dimensions."""
    x = np.random.default_rng([node & (1 << 64) - 1, tree]).normal(size=(dims, levels))
    return x / np.linalg.norm(x, axis=0) * dims**0.5


def unit_vectors(vectors: pd.Series) -> np.ndarray:
    """Vectors of equal length as rows of length 1; scaled by their largest component first, so no square is too large or small."""
    x = np.stack(vectors.to_list()).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_cuts(x: np.ndarray, node: int, trees: int, levels: int, spill: float) -> np.ndarray:
    """trees x (2**levels - 1) cuts in the order of a heap, from a sample; NaN where a node is dense or has one vector."""
    width = spill * DENSE_WIDTH / SPILL
    out = np.full((trees, (1 << levels) - 1), np.nan)
    for t in range(trees):
        p = x @ _directions(node, t, levels, x.shape[1])
        parts = [np.arange(len(x))]
        for level in range(levels):
            below = []
            for k, at in enumerate(parts):
                mine = p[at, level]
                cut = np.median(mine) if len(at) > 1 else np.nan
                if not len(at) > 1 or (np.abs(mine - cut) <= width).sum() > max(4, DENSE * len(at)) or mine.min() == mine.max():
                    below += [at[:0], at[:0]]
                    continue
                out[t, (1 << level) - 1 + k] = cut
                below += [at[mine <= cut], at[mine > cut]]
            parts = below
    return out


def descend(x: np.ndarray, node: int, cuts: np.ndarray, levels: int, spill: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, tree, node of the heap reached, whether it has no cut for being dense): one or more for each row and tree."""
    rows, trees, nodes, stopped = [], [], [], []
    for t in range(len(cuts)):
        p = x @ _directions(node, t, levels, x.shape[1])
        at, k = np.arange(len(x)), np.zeros(len(x), np.int64)
        for level in range(levels):
            cut = cuts[t, k]
            dense = np.isnan(cut)
            for out, v in ((rows, at[dense]), (nodes, k[dense]), (trees, np.full(dense.sum(), t)), (stopped, np.ones(dense.sum(), bool))):
                out.append(v)
            at, k, cut = at[~dense], k[~dense], cut[~dense]
            mine = p[at, level]
            low, high = mine <= cut + spill, mine > cut - spill
            at, k = np.concatenate([at[low], at[high]]), np.concatenate([2 * k[low] + 1, 2 * k[high] + 2])
        for out, v in ((rows, at), (nodes, k), (trees, np.full(len(at), t)), (stopped, np.zeros(len(at), bool))):
            out.append(v)
    return np.concatenate(rows), np.concatenate(trees), np.concatenate(nodes), np.concatenate(stopped)


def _fitter(trees: int, spill: float):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        node, levels, parts = (int(group[k].iloc[0]) for k in ("node", "levels", "parts"))
        cuts = fit_cuts(unit_vectors(group.sort_values("id")["v"]), node, trees, levels, spill)
        return pd.DataFrame({"node": [node], "levels": [levels], "parts": [parts], "cuts": [cuts.ravel().tolist()]})

    return fit


def _sender(trees: int, spill: float):
    def send(vectors: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if not len(vectors):
            return pd.DataFrame(columns=["id", "dims", "node", "tree", "place", "dense"])
        x, node, levels = unit_vectors(vectors["v"]), int(model["node"].iloc[0]), int(model["levels"].iloc[0])
        rows, tree, place, dense = descend(x, node, np.array(model["cuts"].iloc[0]).reshape(trees, -1), levels, spill)
        return pd.DataFrame({"id": vectors["id"].to_numpy()[rows], "dims": x.shape[1], "node": node, "tree": tree, "place": place, "dense": dense})

    return send


def grow(classes: DataFrame, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL * (2 - 2 * COSINE) ** 0.5) -> DataFrame:
    """(id, root, v) vectors -> (leaf, id), several rows for vectors that are in several leaves.

    root tells apart what is never compared. As nodes are cut by the medians of a
    sample of at least SAMPLE of their vectors, phases grow with the logarithm of the
    number of vectors, eight levels each.
    """
    live, done, forest = classes.select(F.col("root").alias("node"), "id", F.size("v").alias("dims")), None, trees
    while True:
        size = materialize(live.groupBy("node").agg(F.count("*").alias("n"), F.max("dims").alias("dims")))
        small = live.join(size.where(F.col("n") <= leaf).select("node"), "node").select("node", "id")
        done = small if done is None else done.unionByName(small)
        room = F.floor(F.log2(F.lit(4.0 * GROUP / SAMPLE) / F.col("dims")))  # levels whose sample fits in a task
        levels = F.greatest(F.lit(1), F.least(F.lit(LEVELS), room, F.ceil(F.log2(F.col("n") / (FILL * leaf))))).cast("int")
        big = size.where(F.col("n") > leaf).select("node", "n", levels.alias("levels"), F.ceil(F.col("n") * F.col("dims") / GROUP).alias("parts"))
        if big.isEmpty():
            return done.withColumnRenamed("node", "leaf")
        held = live.join(big, "node").join(classes.select("id", "v"), "id")
        sample = held.where(unit(F.xxhash64("node", "id")) * F.col("n") < SAMPLE * F.pow(2.0, "levels"))
        fits = materialize(sample.groupBy("node").applyInPandas(_fitter(forest, spill), "node long, levels int, parts long, cuts array<double>"))
        # a node's vectors are dealt to groups of a bounded size, each with the node's cuts
        models = fits.select("node", "levels", "cuts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
        dealt = held.select("node", "id", "v", F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"))

        sent = dealt.groupBy("node", "part").cogroup(models.groupBy("node", "part")).applyInPandas(_sender(forest, spill), "id string, dims int, node long, tree int, place long, dense boolean")
        now = materialize(sent.select("id", "dims", F.xxhash64("node", "tree", "place").alias("node"), "dense"))
        done = done.unionByName(now.where("dense").select("node", "id"))
        live, forest = now.where("not dense").select("node", "id", "dims"), 1


def _least_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value that a row of a shares with the same row of b; rows are padded with their last value."""
    out = np.where(a[:, 0] == b[:, 0], a[:, 0], np.iinfo(np.int64).max)  # rows are in order
    rest = np.flatnonzero(a[:, 0] != b[:, 0])
    for k in range(a.shape[1] if len(rest) else 0):
        mine = a[rest, k]
        shared = (b[rest] == mine[:, None]).any(axis=1)
        out[rest] = np.minimum(out[rest], np.where(shared, mine, out[rest]))
    return out


def _compare(cell: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """(id, links, least) of the vectors of one pair of blocks of a leaf.

    links counts the vectors that are linked to it here and in no leaf that comes
    before this one; least is the least id that links in this cell reach.
    """
    cell = cell.sort_values("id", ignore_index=True)
    x = unit_vectors(cell["v"])
    sizes, block = cell["size"].to_numpy(), cell["block"].to_numpy()
    count = np.fromiter(map(len, cell["leaves"]), np.int64, len(cell))
    at = np.cumsum(count) - count
    leaves = np.concatenate(cell["leaves"].to_list())[at[:, None] + np.minimum(np.arange(count.max()), count[:, None] - 1)]
    here, same = cell["leaf"].iloc[0], cell["a"].iloc[0] == cell["b"].iloc[0]
    links, least = np.zeros(len(x), np.int64), np.arange(len(x))  # ids are in order, so places stand for them

    def root(k: np.ndarray) -> np.ndarray:
        while True:
            up = least[k]
            if (up == k).all():
                return k
            k = up

    one = np.flatnonzero(block == cell["a"].iloc[0])
    two = one if same else np.flatnonzero(block == cell["b"].iloc[0])
    for at in range(0, len(one), 256):  # pairs are held for 256 rows at a time
        start = at if same else 0
        i, j = np.nonzero(x[one[at : at + 256]] @ x[two[start:]].T >= cosine)
        i, j = one[i + at], two[j + start]
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 1 << 16):
            p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
            first = _least_common(leaves[p], leaves[q]) == here
            np.add.at(links, p[first], sizes[q[first]])
            np.add.at(links, q[first], sizes[p[first]])
        while len(i):
            p, q = root(i), root(j)
            apart = p != q
            if not apart.any():
                break
            i, j, p, q = i[apart], j[apart], p[apart], q[apart]
            np.minimum.at(least, np.maximum(p, q), np.minimum(p, q))
    least = root(np.arange(len(x)))
    found = (links > 0) | (least != np.arange(len(x)))
    ids = cell["id"].to_numpy()
    return pd.DataFrame({"id": ids[found], "links": links[found], "least": ids[least[found]]})


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda c: c != 0)


def similar_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL, block: int = BLOCK) -> DataFrame:
    """(id, n_links, component_id, kept) for each row.

    Links join vectors of equal labels and dimensions with a cosine of at least
    ``cosine``. A vector that is null, zero or empty, or holds a null or non-finite
    component, has no links; nor has one with a null label or id. Equal vectors of a
    label are linked, and are one class: only classes are compared, and n_links
    counts their vectors. An id may have several different vectors: n_links is then
    the sum over them, and its component holds all that any of them reaches. Repeated
    rows count once. The trees find nearly all links, not surely all; none below the
    cosine is ever reported. An empty table gives an empty result.
    """
    v = F.col(vector_col)
    good = F.coalesce(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & _usable(v), F.lit(False))
    base = rows.where(good).select(F.col(id_col).alias("vec"), F.xxhash64(F.col(label_col), F.size(v)).alias("root"), v.alias("v"))
    # a class is named by 128 bits of its label and vector
    name = F.concat(*[F.lpad(F.hex(F.xxhash64("root", "v", F.lit(k))), 16, "0") for k in (1, 2)])
    named = materialize(base.withColumn("id", name).groupBy("vec", "id").agg(F.first("root").alias("root"), F.first("v").alias("v")))
    classes = materialize(named.groupBy("id").agg(F.min("vec").alias("head"), F.count("*").alias("size"), F.first("root").alias("root"), F.first("v").alias("v")))
    with scratch(rows.sparkSession) as made:
        spots = materialize(grow(classes.select("id", "root", "v"), trees, leaf, spill * (2 - 2 * cosine) ** 0.5))
        made.remove(spots.folder)

    counts = spots.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1").select("leaf", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    mine = spots.groupBy("id").agg(F.sort_array(F.collect_set("leaf")).alias("leaves")).join(classes.select("id", "v", "size"), "id")
    cells = mine.select("*", F.explode("leaves").alias("leaf")).join(counts, "leaf").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("a"), F.greatest("block", k).alias("b"))))
    cells = cells.select("leaf", "id", "block", "leaves", "v", "size", pair.alias("cell")).select("leaf", "id", "block", "leaves", "v", "size", "cell.a", "cell.b")
    found = materialize(cells.groupBy("leaf", "a", "b").applyInPandas(lambda cell: _compare(cell, cosine), "id string, links long, least string"))

    linked = found.groupBy("id").agg(F.sum("links").alias("links"))
    several = named.groupBy("vec").agg(F.min("id").alias("least"), F.count("*").alias("n")).where("n > 1")
    joined = named.select("vec", "id").join(several, "vec").where("id <> least").select(F.col("id").alias("src"), F.col("least").alias("dst"))
    parts = connected_components(found.where("id <> least").select(F.col("id").alias("src"), F.col("least").alias("dst")).unionByName(joined))
    told = classes.select("id", "head", "size").join(linked, "id", "left").join(parts.withColumnRenamed("node", "id"), "id", "left").select("id", "head", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("links"), F.coalesce("component", "id").alias("component"))
    told = materialize(told)
    least = lean(told.groupBy("component").agg(F.min("head").alias("component_id")))
    placed = materialize(told.join(least, "component").select("id", "links", "component_id"))
    each = named.select("vec", "id").join(placed, "id").groupBy(F.col("vec").alias("id")).agg(F.sum("links").alias("links"), F.min("component_id").alias("component_id"))
    out = rows.select(F.col(id_col).alias("id")).join(each, "id", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_vectors(table(spark, sf_dir, "embeddings"))


#: All pairs; the forest's links are these but for the few that every tree parts.
SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e, sqrt(list_dot_product(embedding::double[], embedding::double[])) as n
  from embeddings where label is not null and embedding is not null),
link as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where a.n > 0 and b.n > 0 and isfinite(a.n) and isfinite(b.n) and list_dot_product(a.e, b.e) >= 0.98 * a.n * b.n),
reach as (select vec_id as a, vec_id as r from embeddings union select link.a, reach.r from link join reach on link.b = reach.a),
part as (select a, min(r) as component_id from reach group by a),
deg as (select a, count(*) as n from link group by a)
select vec_id, coalesce(deg.n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings left join deg on vec_id = deg.a join part on vec_id = part.a
"""
