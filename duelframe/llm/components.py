"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step (Kiveris et al. 2014, "Connected Components in MapReduce and Beyond").

    Large: every larger neighbour of u is linked to the least node around u.
    Small: u and its smaller neighbours are linked to the least of them.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    else:
        near = edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    least = near.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("least"))
    both = near.join(least, "src")
    if large:
        out = both.where("dst > src").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    else:
        out = both.select(F.col("dst").alias("src"), F.col("least").alias("dst")).unionByName(
            least.select("src", F.col("least").alias("dst"))
        )
    return out.where("src <> dst").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) links -> (node, component), component being the least node reachable.

    Links with a null end and links of a node to itself are ignored; repeated links
    do no harm; nodes without links don't appear. Each round is a few shuffles
    whose joins AQE may split where a hub is hot, and ends in a table in the shared
    folder. The driver sees two numbers a round; rounds grow with the logarithm of
    the longest chain.
    """
    now = materialize(
        edges.select("src", "dst").where("src is not null and dst is not null and src <> dst").distinct()
    )
    mark = None
    while True:
        row = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")
        ).first()
        if (row.n, row.h) == mark or not row.n:
            break
        mark = (row.n, row.h)
        before, now = now, materialize(_star(_star(now, large=True), large=False))
        discard(before)
    return now.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
        now.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
    )
