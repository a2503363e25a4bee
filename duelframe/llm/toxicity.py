"""Toxic passages as maximum-scoring segments of a text's tokens.

Each token scores its log-odds between toxic and clean labelled texts under an
informative Dirichlet prior, the tokens' shares in all labelled texts (Monroe, Colaresi
and Quinn 2008, "Fightin' Words"), shrunk towards 0 by their variance, less a drift
that every token costs. A linear scan finds every maximal segment (Ruzzo and Tompa
1999). A segment of score S appears by chance in n clean tokens with expectation
K n exp(-lambda S), the extreme-value law of Karlin and Altschul (1990); lambda and K
are estimated from the best segments of all labelled clean texts, so they hold what
words of a language or a subject add up to. The normalised scores of a text's
significant segments are summed, and a logistic curve fitted on labelled texts turns
the sum into a probability.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelframe.llm.common import BROADCAST_ROWS, id_bucket, lean, materialize, table, text_hash, unit, unused

TOKEN = re.compile(r"[^\W_]+")
#: Leading characters of a word that count as a feature of their own, for words too rare to be known.
STEM = 5
#: Distinct tokens that a counting task holds before it hands on partial counts.
HELD = 50_000
#: Labelled ids that are learned from; every task gets them, about 20 MB.
MOST_LABELS = BROADCAST_ROWS
#: The evidence of a text without a segment, and the most that any has.
NONE, MOST = -12.0, 40.0


#: Terms that the driver and the tasks hold; the others are joined.
IN_PLACE = 32_768
#: Rates that the extreme-value law is fitted over, and the clean texts with a segment that it takes at least.
RATES, LEAST_TEXTS = [0.05 * 400 ** (k / 59) for k in range(60)], 10


@dataclass
class Lexicon:
    """Scores of the counted tokens and stems, and of any other token.

    Where there are more terms than tasks should hold, words and stems are those held,
    rest is the table of all, and top the most that a term not held can score.
    """

    words: dict[str, float]
    stems: dict[str, float]
    other: float
    k: float  # of the extreme-value law
    rate: float = 1.0  # its lambda
    top: float | None = None
    rest: DataFrame | None = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "rest": None}  # tasks don't read tables

    def bound(self, word: str) -> float:
        """The weight of a word, or the most that it can be if the word isn't held."""
        if self.top is None or word in self.words:
            return self.weight(word)
        return max(self.top, self.weight(word))

    def weight(self, word: str) -> float:
        found = self.words.get(word)
        if found is None:
            found = self.stems.get(word[:STEM], self.other) if len(word) > STEM else self.other
        return found


def segments(weights: np.ndarray) -> list[tuple[int, int, float]]:
    """Every maximal scoring segment as (start, end, score), in linear time.

    A segment starts and ends with a positive weight, so only those are visited;
    what lies between them is in the running sums.
    """
    up = np.flatnonzero(weights > 0)
    if not len(up):
        return []
    sums = np.concatenate(([0.0], np.cumsum(weights)))
    stack: list[tuple[int, int, float, float]] = []  # start, end, sum before start, sum at end
    for at in up.tolist():
        now = (at, at + 1, float(sums[at]), float(sums[at + 1]))
        while stack:
            # the nearest earlier candidate whose left sum is smaller; those above it can't be joined any more
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= now[2]:
                j -= 1
            if j < 0 or stack[j][3] >= now[3]:
                break
            now = (stack[j][0], now[1], stack[j][2], now[3])
            del stack[j:]
        stack.append(now)
    return [(a, b, r - l) for a, b, l, r in stack]


def _marks(labels: DataFrame, id_col: str, label_col: str, learn: Column, most: int) -> DataFrame:
    """(id, toxic) to learn from: at most about `most` ids, chosen by a hash, so that they can be given to every task.

    A repeated label counts once, as toxic if one says so.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where(learn).where("toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic"))
    marks = materialize(marks)
    return F.broadcast(marks.where(unit(F.xxhash64("id", F.lit(4))) < min(1.0, most / max(1, marks.count()))))


def _labelled(docs: DataFrame, marks: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(marks, "id")


def _counts(labelled: DataFrame) -> DataFrame:
    """(kind, token, toxic, clean): how many labelled texts of each class have a word (kind 0) or a stem (kind 1).

    A text counts a token once, however often it repeats it: repetitions within a
    text are no independent evidence.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = {(k, c): Counter() for k in (0, 1) for c in (0, 1)}

        def out() -> pd.DataFrame:
            parts = [pd.DataFrame({"kind": k, "token": list(v), "toxic": list(v.values()) if c else 0, "clean": 0 if c else list(v.values())}) for (k, c), v in held.items() if v]
            for v in held.values():
                v.clear()
            return pd.concat(parts)

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
                words = set(TOKEN.findall((text or "").lower()))
                c = int(toxic > 0)
                held[0, c].update(words)
                held[1, c].update({w[:STEM] for w in words if len(w) > STEM})
                if sum(map(len, held.values())) > HELD:
                    yield out()
        if any(held.values()):
            yield out()

    parts = labelled.select("text", "toxic").mapInPandas(count, "kind int, token string, toxic long, clean long")
    return parts.groupBy("kind", "token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def term_scores(counts: DataFrame, *, prior: float = 0.1, spread: float = 2.0, drift: float = 1.2) -> DataFrame | None:
    """(kind, token, n, score) of every counted word and stem; None without labelled texts of both classes.

    prior is the weight of the Dirichlet prior as a share of all counts. The log-odds
    are estimates with a variance; with `spread`, the variance of the true log-odds
    around 0, the score is their posterior mean, less drift. So a rare term scores
    near -drift, and one typical of clean texts lower.
    """
    totals = {r.kind: (float(r.t), float(r.c)) for r in counts.groupBy("kind").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")).collect()}
    if not totals.get(0) or not all(totals[0]):
        return None
    sums = [F.when(F.col("kind") == 0, totals[0][c]).otherwise(totals.get(1, totals[0])[c]) for c in (0, 1)]
    a, b = F.lit(prior) * (F.col("toxic") + F.col("clean")), F.lit(prior) * (sums[0] + sums[1])
    y1, y0 = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(y1 / (sums[0] + b - y1)) - F.log(y0 / (sums[1] + b - y0))
    score = delta * F.lit(spread) / (F.lit(spread) + 1 / y1 + 1 / y0) - F.lit(drift)
    return counts.select("kind", "token", (F.col("toxic") + F.col("clean")).alias("n"), score.alias("score"))


def fit_law(best: DataFrame) -> tuple[float, float]:
    """(lambda, K) of greatest likelihood for (best, tokens), the best segments' scores in clean texts and the texts' lengths.

    With K at its best for a lambda, the likelihood needs only sums over the texts:
    one row of sums, for 60 lambdas from 0.05 to 20. With fewer than LEAST_TEXTS
    texts that have a segment, lambda is 1, as for exact log-odds, and K what one
    more such text among all these tokens would make it.
    """
    has = F.col("best") > 0
    sums = [F.sum(F.when(has, F.col("tokens") * F.exp(F.lit(-x) * F.col("best")))).alias(f"s{k}") for k, x in enumerate(RATES)]
    row = best.agg(F.count_if(has).alias("n"), F.sum("best").alias("total"), F.sum(F.col("tokens") * F.exp(-F.col("best"))).alias("one"), *sums).first()
    if row.n < LEAST_TEXTS:
        return 1.0, (row.n + 1) / row.one if row.one else 0.3
    fits = [(row.n * (math.log(x) + math.log(row.n / row[f"s{k}"])) - x * row.total, x, row.n / row[f"s{k}"]) for k, x in enumerate(RATES) if row[f"s{k}"] > 0]
    return max(fits)[1:]


def fit_lexicon(labelled: DataFrame, *, in_place: int = IN_PLACE, **scoring) -> Lexicon:
    """Scores of all labelled texts' words and stems, and the law of their segments in all labelled clean texts.

    The driver receives, and tasks hold, at most in_place terms: half of them those
    with the highest scores, half the most frequent. The others stay in a table that
    tokens are joined to where they matter (_found), so in_place changes no result.
    """
    drift = scoring.get("drift", 1.2)
    scores = term_scores(materialize(_counts(labelled)), **scoring)
    if scores is None:
        return Lexicon({}, {}, -drift, 0.3)
    half = max(1, in_place // 2)
    highest = scores.orderBy(F.desc("score"), "kind", "token").limit(half).collect()
    whole = len(highest) < half
    frequent = [] if whole else scores.orderBy(F.desc("n"), "kind", "token").limit(half).collect()
    found = {}, {}
    for r in [*highest, *frequent]:
        found[r.kind][r.token] = r.score
    lexicon = Lexicon(*found, -drift, 0.3)
    if not whole:
        lexicon.top, lexicon.rest = max(-drift, highest[-1].score), scores
    lexicon.rate, lexicon.k = fit_law(_found(labelled.where("toxic <= 0").select("text"), lexicon).select("found.best", "found.tokens"))
    return lexicon


def _judge(found: list[tuple[int, int, float]], n: int, lexicon: Lexicon, significant: float) -> tuple[float, float, int, int, int]:
    if not found:
        return NONE, 0.0, 0, -1, -1
    base, rate = math.log(lexicon.k * n), lexicon.rate
    best = max(found, key=lambda s: (s[2], -s[0]))
    good = [s for s in found if rate * s[2] - base > -math.log(significant)]
    top = rate * best[2] - base
    evidence = max(sum(rate * s[2] - base for s in good), top) if good else top
    return min(MOST, max(NONE, evidence)), best[2], len(good), best[0], best[1]


def scan(text: str | None, lexicon: Lexicon, significant: float = 0.05) -> tuple[float, float, int, int, int]:
    """(evidence, best segment's score, significant segments, its first token, its last token + 1).

    A segment's normalised score is lambda S - ln(K n). The evidence is the sum over
    the significant segments, or the best one's if that is more, from NONE to MOST. Only
    for a lexicon that holds all terms, as passages is; tables are scanned with any.
    """
    words = TOKEN.findall(text.lower()) if text else []
    return _judge(segments(np.array([lexicon.weight(w) for w in words])), len(words), lexicon, significant)


def passages(text: str | None, lexicon: Lexicon, significant: float = 0.05) -> list[tuple[int, int, float]]:
    """Character spans of a text's significant segments, with the chance of as good a one in clean text of its length."""
    spans = [m.span() for m in TOKEN.finditer(text)] if text else []
    if not spans:
        return []
    weights = np.array([lexicon.weight(text[a:b].lower()) for a, b in spans])
    out = []
    for a, b, s in segments(weights):
        e = lexicon.k * len(spans) * math.exp(-lexicon.rate * s)
        if e < significant:
            out.append((spans[a][0], spans[b - 1][1], -math.expm1(-e)))
    return out


class _Weights(dict):
    """Weights, or bounds of them, of the words met lately."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) > HELD:
            self.clear()
        self[word] = found = self.lexicon.bound(word)
        return found


FOUND = "evidence double, best double, passages int, first_token int, last_token int, tokens int, need array<string>"


def _row(words: list[str], weights: np.ndarray, lexicon: Lexicon, resolved: bool) -> tuple:
    """What a scan finds, and the words that it needs to know first, or None: those in a segment, but not held."""
    found = segments(weights)
    need = None
    if lexicon.top is not None and not resolved:
        need = sorted({w for a, b, _ in found for w in words[a:b] if w not in lexicon.words}) or None
    return (*_judge(found, len(words), lexicon, 0.05), len(words), need)


def _found(rows: DataFrame, lexicon: Lexicon, text_col: str = "text", name: str = "found") -> DataFrame:
    """rows with a struct of what the scan of their text finds, whole texts; the texts become null where they have been read for good.

    A first scan gives words that aren't held the most they can score. Any run whose
    prefixes and suffixes are all positive under the true scores is so under these, so
    every maximal segment lies in one of the first scan's, and words outside of those
    don't matter. Texts whose segments hold only known words are done; for the others,
    the unknown words of their segments are joined to the table of all terms, and the
    text is scanned again.
    """
    columns = FOUND.replace(" double", "").replace(" int", "").replace(" array<string>", "").split(", ")

    @F.pandas_udf(FOUND)
    def scans(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = _Weights(lexicon)
        for texts in batches:
            out = []
            for text in texts:
                words = TOKEN.findall(text.lower()) if text else []
                out.append(_row(words, np.fromiter(map(weights.__getitem__, words), np.float64, len(words)), lexicon, False))
            yield pd.DataFrame(out, columns=columns)

    @F.pandas_udf(FOUND)
    def rescans(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        weights = _Weights(lexicon)
        for batch in batches:
            out = []
            for text, known, scores in zip(*batch, strict=True):
                words, own = TOKEN.findall(text.lower()), dict(zip(known, scores, strict=True))
                w = np.fromiter((own[x] if x in own else weights[x] for x in words), np.float64, len(words))
                out.append(_row(words, w, lexicon, True))
            yield pd.DataFrame(out, columns=columns)

    marked = rows.withColumn(name, scans(F.col(text_col)))
    if lexicon.top is None:
        return marked
    open_ = F.col(name)["need"].isNotNull()
    marked = materialize(marked.withColumn(text_col, F.when(open_, F.col(text_col))))
    a, b, terms = (unused(marked, x) for x in ("key_a", "key_b", "terms"))
    rest = marked.where(open_).withColumns({a: F.xxhash64(text_col, F.lit(1)), b: F.xxhash64(text_col, F.lit(2))})
    needs = rest.select(F.col(a).alias("a"), F.col(b).alias("b"), F.explode(F.col(name)["need"]).alias("word")).distinct()
    needs = needs.withColumn("stem", F.when(F.length("word") > STEM, F.substring("word", 1, STEM)))
    own = lexicon.rest.where("kind = 0").select(F.col("token").alias("word"), F.col("score").alias("own"))
    by_stem = lexicon.rest.where("kind = 1").select(F.col("token").alias("stem"), F.col("score").alias("by_stem"))
    scored = needs.join(own, "word", "left").join(by_stem, "stem", "left").select("a", "b", "word", F.coalesce("own", "by_stem", F.lit(lexicon.other)).alias("score"))
    known = scored.groupBy(F.col("a").alias(a), F.col("b").alias(b)).agg(F.collect_list(F.struct("word", "score")).alias(terms))
    again = rest.join(known, [a, b]).withColumn(name, rescans(F.col(text_col), F.col(terms)["word"], F.col(terms)["score"]))
    return marked.where(~open_).unionByName(again.drop(a, b, terms))


def scan_documents(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, evidence, best, passages, first_token, last_token) of every row, whole texts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _found(rows, lexicon).select("id", *[f"found.{c}" for c in ("evidence", "best", "passages", "first_token", "last_token")])


def fit_calibration(evidence: DataFrame) -> tuple[float, float]:
    """(slope, offset) of the logistic curve from evidence to the label, on all labelled rows.

    The rows come as a histogram of the evidence in steps of an eighth, so the
    driver receives at most 834 rows.
    """
    rows = evidence.groupBy((F.round(F.col("evidence") * 8) / 8).alias("x"), (F.col("toxic") > 0).alias("y")).agg(F.count("*").alias("n")).orderBy("x", "y").collect()
    x, y, n = (np.array([float(v) for v in column]) for column in zip(*rows, strict=True)) if rows else (np.zeros(0),) * 3
    w = np.array([0.5, -1.0])
    if not y.any() or y.all():
        return tuple(w)
    n = n * (100 / n.sum())
    design, ridge = np.stack([x, np.ones_like(x)]), 0.01
    for _ in range(100):  # Newton's steps
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        grad = design @ (n * (p - y)) + ridge * w
        hess = (design * (n * p * (1 - p))) @ design.T + ridge * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
    return float(w[0]), float(w[1])


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, folds: int = 5, held_fold: int = 0, most_labels: int = MOST_LABELS, **fitting) -> DataFrame:
    """(id, held_out, score, predicted, passages, best, first_token, last_token) for each row of docs.

    Learns only from labelled rows where crc32(id as text) mod folds is neither
    held_fold nor null, and from at most about most_labels ids. A repeated label
    counts once, as toxic if one says so. Null and empty texts, and texts without a
    token, have no evidence and get the same low score. Equal texts get equal scores.
    Without labels of both classes no text has evidence. An empty table gives an empty
    result; only named columns are read.
    """
    marks = _marks(labels, id_col, label_col, id_bucket(F.col("id"), folds) != held_fold, most_labels)
    lexicon = fit_lexicon(materialize(_labelled(docs, marks, id_col, text_col)), **fitting)
    found = materialize(scan_documents(docs, lexicon, id_col, text_col))
    slope, offset = fit_calibration(found.select("id", "evidence").join(marks, "id"))
    score = 1 / (1 + F.exp(-(F.lit(slope) * F.col("evidence") + F.lit(offset))))
    return found.select(
        F.col("id").alias(id_col), F.coalesce(id_bucket(F.col("id"), folds) == held_fold, F.lit(False)).alias("held_out"), score.alias("score"),
        F.when(score >= 0.5, 1).otherwise(0).alias("predicted"), "passages", "best", "first_token", "last_token",
    )


def keep_clean(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", *, most_labels: int = MOST_LABELS, **fitting) -> DataFrame:
    """docs whose score stays under 0.5; the score depends on the text alone, so every row is judged by its own text."""
    train = materialize(_labelled(docs, _marks(labels, id_col, label_col, id_bucket(F.col("id"), 5) != 0, most_labels), id_col, text_col))
    lexicon = fit_lexicon(train, **fitting)
    found = scan_documents(train.select("toxic", "text", F.col("toxic").alias("id")), lexicon, "id", "text")
    slope, offset = fit_calibration(found.select("evidence", F.col("id").alias("toxic")))

    a, b = unused(docs, "a"), unused(docs, "b")
    hashes = {a: text_hash(F.col(text_col), 3), b: text_hash(F.col(text_col), 4)}
    found = _found(docs.select(F.col(text_col).alias("text"), *[v.alias(k) for k, v in hashes.items()]), lexicon)
    rejected = found.where(F.lit(slope) * F.col("found")["evidence"] + F.lit(offset) >= 0).select(a, b).distinct()
    return docs.withColumns(hashes).join(lean(rejected), [a, b], "left_anti").select(*docs.columns)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
