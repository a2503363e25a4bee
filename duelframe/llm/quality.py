"""A quality classifier from weak labels.

Overlapping heuristics vote good, bad or nothing on every text. Expectation
maximisation over the counts of vote patterns estimates how each heuristic votes on
good and on bad texts (Dawid and Skene 1979), and gives each pattern a posterior.
The posteriors of a bounded sample train a linear scorer on hashed features, which
scores every text. No labels are used.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from duelframe.llm.common import materialize, table, text_hash, unit

ABSTAIN, BAD, GOOD = 0, 1, 2
BUCKETS = 1 << 14
#: Texts, chosen by a hash of id and text, that train the scorer.
SAMPLE = 4000
_ODD = re.compile(r"[^\w\s.,;:'\"!?()\-–—’“”«»¿¡…]")
_RUNS = re.compile(r"(.)\1+")


def _vote(value: float, good: float, bad: float) -> int:
    """GOOD up to good, BAD from bad on, ABSTAIN between."""
    return GOOD if value <= good else BAD if value >= bad else ABSTAIN


def votes(text: str | None) -> str:
    """One digit for each heuristic; a text of no words is bad to all that see it."""
    words = text.split() if text else []
    if not words:
        return "1" * len(HEURISTICS)
    n, size = len(words) + 10, len(text) + 60  # a short text tells little, and is spared
    letters = sum(map(str.isalpha, text))
    lines = [x for x in (y.strip() for y in text.split("\n")) if x]
    chunks = [words[k : k + 100] for k in range(0, len(words), 100)]
    fresh = [len(set(c)) / len(c) for c in chunks if len(c) >= 20]
    measures = (
        (sum(a == b for a, b in zip(words, words[1:])) / n, 0.02, 0.2),  # a word after itself
        (1 - sum(fresh) / len(fresh) if fresh else 0.45, 0.4, 0.6),  # words seen before, of 100
        (sum(map(str.isupper, text)) / (letters + 40), 0.15, 0.5),  # capitals among letters
        (len(_ODD.findall(text)) / size, 0.005, 0.04),  # odd symbols
        (text.count("!") / n, 0.05, 0.3),  # exclamation marks
        (1 - len(set(lines)) / len(lines) if len(lines) > 3 else 0.15, 0.1, 0.3),  # repeated lines
        ((len(text) - letters) / size, 0.25, 0.4),  # what isn't a letter
        (sum(map(len, words)) / n, 9.0, 15.0),  # long words
        (sum(w in ("|", "*", "#", "-", "•") for w in words) / n, 0.01, 0.15),  # bare marks, as in tables
    )
    return "".join(str(_vote(*m)) for m in measures)


HEURISTICS = ("word_after_itself", "words_seen_before", "capitals", "odd_symbols", "exclamations", "repeated_lines", "not_letters", "long_words", "bare_marks")


def accuracies(patterns: dict[str, int], rounds: int = 100, smooth: float = 1e-4) -> tuple[float, np.ndarray]:
    """(share of good texts, P(vote | good or bad)) by expectation maximisation.

    patterns counts texts by their votes. The start is the share of good among each
    text's votes; more good than bad texts are assumed only where all is symmetric.
    smooth is a share of all texts, so that estimates hang on the patterns' shares alone.
    """
    keys = sorted(patterns)
    v = np.array([[int(c) for c in k] for k in keys])
    n = np.array([patterns[k] for k in keys], float)
    n = n / n.sum()
    cast = np.maximum(1, (v != ABSTAIN).sum(1))
    post = np.clip(((v == GOOD).sum(1) + 1.0) / (cast + 1.5), 0.02, 0.98)
    post = np.where((v == BAD).any(1), np.minimum(post, 0.3 + 0.4 * (v == GOOD).sum(1) / cast), post)
    for _ in range(rounds):
        share = float((n @ post + smooth) / (n.sum() + 2 * smooth))
        table_ = np.stack([np.stack([((v == k) * (n * w)[:, None]).sum(0) + smooth for k in range(3)]) / ((n @ w) + 3 * smooth) for w in (1 - post, post)])  # class x vote x heuristic
        new = _posterior(v, share, table_)
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    return share, table_


def _posterior(v: np.ndarray, share: float, rates: np.ndarray) -> np.ndarray:
    """P(good) of each row of votes; an abstention says nothing, so rates are taken among cast votes."""
    h = np.arange(v.shape[1])
    told = np.log(rates) - np.log(rates[:, 1:].sum(1, keepdims=True))
    odds = np.log(share / (1 - share)) + np.where(v == ABSTAIN, 0, told[1][v, h] - told[0][v, h]).sum(1)
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def posterior(pattern: str, share: float, rates: np.ndarray) -> float:
    return float(_posterior(np.array([[int(c) for c in pattern]]), share, rates)[0])


class Features:
    """Hashed features of a text, as sorted buckets and weights of unit length."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def _shape(self, word: str) -> int:
        """The bucket of a word's shape: runs of capitals, small letters, digits and other characters, other characters as they are."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > 200_000:
                self.known.clear()
            shape = _RUNS.sub(r"\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word))
            found = self.known[word] = zlib.crc32(shape.encode()) % BUCKETS
        return found

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = text.split() if text else []
        if not words:
            return np.array([zlib.crc32(b"\0empty") % BUCKETS]), np.ones(1)
        n = len(words)
        shapes = np.fromiter(map(self._shape, words), np.int64, n)
        pairs = (shapes[:-1] * 31 + shapes[1:] + 7) % BUCKETS
        same = sum(a == b for a, b in zip(words, words[1:])) / n
        fresh = [len(set(words[k : k + 100])) / 100 for k in range(0, n - 99, 100)]  # of fewer than 100 words nearly all are new
        extra = [b"\0one", b"\0same%d" % min(9, round(same * 10)), b"\0fresh%d" % round(np.mean(fresh) * 10) if fresh else b"\0short"]
        extra = [zlib.crc32(x) % BUCKETS for x in extra]
        counts = np.bincount(np.concatenate([shapes, pairs]), minlength=BUCKETS)
        at = np.flatnonzero(counts)
        weight = np.sqrt(counts[at] / n) * (n / (n + 20))  # the fewer words, the less their shapes tell
        at, weight = np.concatenate([at, extra]), np.concatenate([weight, np.ones(len(extra))])
        return at, weight / np.sqrt((weight**2).sum())


def fit_scorer(sample: list[tuple[np.ndarray, np.ndarray, float]], epochs: int = 12, rate: float = 2.0, seed: int = 3) -> np.ndarray:
    """Weights of a logistic scorer on soft labels, by averaged stochastic gradient descent."""
    rng = np.random.default_rng(seed)
    w, total = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for e in range(epochs):
        for k in rng.permutation(len(sample)):
            at, x, y = sample[k]
            p = 1 / (1 + np.exp(-np.clip(w[at] @ x, -30, 30)))
            np.add.at(w, at, rate / (1 + e) * (y - p) * x)
        total += w
    return total / epochs


@F.pandas_udf(StringType())
def _votes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([votes(x) for x in texts], dtype=object)


@F.pandas_udf(StructType([StructField("at", BinaryType()), StructField("x", BinaryType())]))
def _features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    features = Features()
    for texts in batches:
        both = [features(x) for x in texts]
        yield pd.DataFrame({"at": [a.astype(np.int32).tobytes() for a, _ in both], "x": [x.astype(np.float32).tobytes() for _, x in both]})


def _train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The scorer's weights, from a sample in one task."""
    rows = pd.concat(batches).sort_values("h")
    sample = [(np.frombuffer(at, np.int32), np.frombuffer(x, np.float32).astype(float), y) for at, x, y in zip(rows["at"], rows["x"], rows["y"], strict=True)]
    yield pd.DataFrame({"w": [fit_scorer(sample).tobytes()]})


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, sample: int = SAMPLE) -> DataFrame:
    """(id, score, predicted, keep, votes, weak_posterior) for each row of docs.

    score is the scorer's probability that the text is good; predicted is 1, and keep
    true, from 0.5 on. A null text and one without words are bad to every heuristic.
    Equal texts get equal scores, repeated rows come back as often as they are; an
    empty table gives an empty result; other columns aren't read. Every text is voted
    on once. The driver receives the counts of at most 3 ** 9 vote patterns and the
    weights; the features of about `sample` distinct rows meet in one task.
    """
    text = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumns({"a": text_hash(text, 1), "b": text_hash(text, 2)})
    kind = rows.schema["id"].dataType.simpleString()
    cast = materialize(rows.select("a", "b", _votes("text").alias("votes")))
    counts = {r.votes: r.n for r in cast.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return docs.sparkSession.createDataFrame([], f"`{id_col}` {kind}, score double, predicted int, keep boolean, votes string, weak_posterior double")
    share, rates = accuracies(counts)
    weak = docs.sparkSession.createDataFrame([(k, posterior(k, share, rates)) for k in counts], "votes string, weak_posterior double")
    told = materialize(cast.groupBy("a", "b").agg(F.first("votes").alias("votes")).join(F.broadcast(weak), "votes"))

    h = F.xxhash64("id", "a", "b")
    picked = rows.withColumn("h", h).where(unit(F.col("h")) < min(1.0, sample / sum(counts.values()))).select("h", "a", "b", _features("text").alias("f")).dropDuplicates(["h"])
    learned = picked.join(told, ["a", "b"]).select("h", "f.at", "f.x", F.col("weak_posterior").alias("y")).repartition(1).mapInPandas(_train, "w binary").first()
    w = np.frombuffer(learned.w, float) if learned else np.zeros(BUCKETS)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features = Features()
        for texts in batches:
            p = np.array([w[at] @ x for at, x in map(features, texts)])
            yield pd.Series(1 / (1 + np.exp(-np.clip(p, -30, 30))))

    scored = rows.select("id", "a", "b", score("text").alias("score")).join(told, ["a", "b"])
    good = F.col("score") >= 0.5
    return scored.select(F.col("id").alias(id_col), "score", good.cast("int").alias("predicted"), good.alias("keep"), "votes", "weak_posterior")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"))
