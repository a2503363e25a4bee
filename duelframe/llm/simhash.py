"""SimHash near-duplicates, linked through tables of distances to pivots.

Fingerprints within ``MAX_BITS`` differing bits are linked. Every distinct
fingerprint gets a table of Hamming distances to fixed reference fingerprints,
the pivots. By the triangle inequality the distances of two linked fingerprints to
any pivot differ by at most ``MAX_BITS``, so a pair with a larger coordinate
difference is discarded unseen; survivors are verified bit by bit.

To find the pairs without comparing all of them, distances are also taken over
projections: with the word cut in four blocks, two fingerprints that differ in at
most two bits agree on at least two blocks, so over that half word their distances
to all pivots are equal. The distances over each of the six half words are hashed to
a key and equi-joined. What agrees there differs in at most two bits of the other half
word, so a key that many fingerprints share is parted further in the same way: by
distances over two of four blocks of the other half, and again over what is then left.
No link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from duelframe.llm.common import lean, materialize, table, text_hash, unused
from duelframe.llm.components import connected_components

MAX_BITS = 2
SHINGLE = 3
SEED = 42
#: Keys with more fingerprints than this are parted further before their fingerprints are paired.
PAIRED = 32
#: The pivots. Two random half words are at equal distances from all 16 less often than they are equal.
PIVOTS = 16


def _halves(bits: list[int]) -> list[tuple[int, list[int]]]:
    """(mask, other bits) for each two of four blocks of the bits."""
    n = len(bits) // 4
    blocks = [bits[n * k : n * k + n] for k in range(4)]
    out = []
    for pair in combinations(range(4), 2):
        mask = sum(1 << b for k in pair for b in blocks[k])
        out.append((mask, [b for k in range(4) if k not in pair for b in blocks[k]]))
    return out


def _masks() -> list[list[int]]:
    """The masks of each level: six half words, for each six quarters of the other half, for each six eighths of what is left."""
    levels, open_ = [], [list(range(64))]
    for _ in range(3):
        parts = [x for bits in open_ for x in _halves(bits)]
        levels.append([mask for mask, _ in parts])
        open_ = [rest for _, rest in parts]
    return levels


LEVELS = _masks()


def _signed(x: int) -> int:
    x &= (1 << 64) - 1
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int, seed: int = 9) -> list[int]:
    """n reference fingerprints from the SplitMix64 sequence."""
    out, state = [], seed
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & (1 << 64) - 1
        z = state
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1
        z = (z ^ z >> 27) * 0x94D049BB133111EB & (1 << 64) - 1
        out.append(z ^ z >> 31)
    return out


def fingerprint(text: str | None) -> int:
    """The signed 64-bit SimHash of a text's word shingles; 0 without words."""
    words = text.encode().lower().split() if text else ()  # of bytes, both are ASCII only
    if not words:
        return 0
    buffer = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(buffer[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())),
        np.uint64,
        len(words) - k + 1,
    )
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


@F.pandas_udf(LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([fingerprint(x) for x in texts], dtype="int64")


def fingerprints(docs: DataFrame, text_col: str = "text") -> Column:
    return _fingerprints(docs[text_col])


def _distance(a: Column, b: Column | int, mask: Column | None = None) -> Column:
    other = b if isinstance(b, Column) else F.lit(_signed(b)).cast("long")
    differing = a.bitwiseXOR(other)
    return F.bit_count(differing if mask is None else differing.bitwiseAND(mask))


def _parted(prints: DataFrame, level: int) -> DataFrame:
    """(fp, path, key) -> the same of the next level: six rows for each, keyed by the distances over six masks."""
    masks = F.array(*[F.lit(_signed(m)).cast("long") for m in LEVELS[level]])
    path = F.col("path") * 6 + F.col("k")
    each = prints.select("fp", "key", "path", F.explode(F.array(*map(F.lit, range(6)))).alias("k")).select("fp", "key", path.alias("path"), masks[path].alias("mask"))
    distances = [_distance(F.col("fp"), p, F.col("mask")) for p in pivots(PIVOTS)]
    return each.select("fp", "path", F.xxhash64("key", "path", *distances).alias("key"))


def _verified(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) within MAX_BITS; most others go by their distances to the pivots, eight packed in a long."""
    refs = pivots(PIVOTS)

    def packed(x: Column, t: int) -> Column:
        out = F.lit(0).cast("long")
        for k, p in enumerate(refs[8 * t : 8 * t + 8]):
            out = out.bitwiseOR(F.shiftleft(_distance(x, p).cast("long"), 8 * k))
        return out

    tables = pairs.select("a", "b", *[packed(F.col(side), t).alias(f"{side}{t}") for side in "ab" for t in range(PIVOTS // 8)])
    at = lambda name, k: F.shiftright(F.col(f"{name}{k // 8}"), 8 * (k % 8)).bitwiseAND(F.lit(255).cast("long"))
    apart = F.greatest(*[F.abs(at("a", k) - at("b", k)) for k in range(PIVOTS)])
    return tables.where(apart <= MAX_BITS).where(_distance(F.col("a"), F.col("b")) <= MAX_BITS).select("a", "b")


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """(fp) distinct signed fingerprints -> (src, dst), all pairs within MAX_BITS.

    Pairs that share a key are compared one by one. A key with more than PAIRED
    fingerprints would make many pairs, so its fingerprints are keyed again over what
    the key leaves open. After the third level a key has equal distances over 56 of
    the 64 bits, which leaves few fingerprints however many there are in all.
    """
    keyed = prints.select("fp", F.lit(0).alias("path"), F.lit(0).cast("long").alias("key"))
    out = None
    for level in range(len(LEVELS)):
        keyed = _parted(keyed, level)
        shared = materialize(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1"))
        most = PAIRED if level + 1 < len(LEVELS) else 1 << 62
        few = keyed.join(shared.where((F.col("n") > 2) & (F.col("n") <= most)).select("key"), "key").select("key", "fp")
        pairs = few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), "key").where("a < b").select("a", "b")
        found = _verified(pairs.unionByName(shared.where("n = 2").select("a", "b")))
        out = found if out is None else out.unionByName(found)
        crowds = shared.where(F.col("n") > most).select("key")
        if crowds.isEmpty():
            break
        keyed = materialize(keyed.join(crowds, "key"))
    return out.distinct().toDF("src", "dst")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: (id, fp signed long, component_id).

    component_id is the least id whose fingerprint can be reached. Null and empty
    texts have fingerprint 0 and are linked like any other. A null id gets its
    class's component and is never one itself, unless the class has no other.
    Repeated rows come back as often as they are. Copies share a fingerprint, and
    only distinct fingerprints are compared, so a class of copies of any size costs
    one row. A task holds the words of one text and a hash for each shingle, whatever
    the text's length. An empty table gives an empty result. Columns other than the
    two named are not read.
    """
    return _components(docs, id_col, text_col).drop("h")


def _components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """simhash_components with h, a hash of the text."""
    rows = materialize(docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col), 9).alias("h"), fingerprints(docs, text_col).alias("fp")))
    classes = materialize(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    found = connected_components(fingerprint_links(classes.select("fp")))
    joined = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = joined.join(least, "component").select("fp", "component_id")
    return rows.join(named, "fp").select("id", "h", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """simhash_components with the fingerprint as 16 hexadecimal digits."""
    return simhash_components(docs, id_col, text_col).select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without near-duplicates: of each component the row with the least id stays.

    Of rows that repeat this id one stays, with a text whose component has the id's
    name; of several such texts, and of rows that share it, that with the least hash.
    Rows with a null id can't be named as anyone's duplicate and stay.
    """
    found = _components(docs, id_col, text_col).where("id is not null")
    texts = found.groupBy("id", "h").agg(F.count("*").alias("n"), F.max(F.col("id") == F.col("component_id")).alias("head"))
    chosen = texts.groupBy("id").agg(F.count("*").alias("texts"), F.sum("n").alias("n"), F.min(F.when(F.col("head"), F.col("h"))).alias("h"))
    # what goes, and what repeats, are ids that are fewer than the documents
    marks = chosen.where("h is null or n > 1").select(F.col("id"), F.when(F.col("h").isNotNull(), F.col("h")).alias("h"))
    key, own, row = unused(docs, "marked"), unused(docs, "own"), unused(docs, "row")
    marked = docs.withColumn(own, F.col(id_col)).join(lean(marks.select(F.col("id").alias(own), F.struct("h").alias(key))), own, "left").drop(own)
    single = marked.where(F.col(key).isNull()).drop(key)
    names = [c for c in docs.columns if c != id_col]
    repeats = marked.where(F.col(key)["h"] == text_hash(F.col(text_col), 9))
    one = repeats.groupBy(id_col).agg(F.min_by(F.struct(*names), F.xxhash64(*names)).alias(row))
    return single.unionByName(one.select(id_col, *[F.col(row)[c].alias(c) for c in names]).select(*docs.columns))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
