from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from duelframe.llm import quality
from duelframe.llm.common import table

SF = "/root/testdata/sf0.1"


def test_accuracies_are_recovered():
    rng = np.random.default_rng(0)
    good = rng.random(20000) < 0.8
    right, silent = [0.95, 0.8, 0.7, 0.9, 0.65], [0.0, 0.2, 0.1, 0.5, 0.3]
    columns = []
    for p, s in zip(right, silent, strict=True):
        vote = np.where(rng.random(20000) < p, good, ~good) + 1
        columns.append(np.where(rng.random(20000) < s, 0, vote))
    patterns = {}
    for row in np.stack(columns, 1):
        key = "".join(map(str, row))
        patterns[key] = patterns.get(key, 0) + 1
    share, rates = quality.accuracies(patterns)
    assert abs(share - 0.8) < 0.03
    for k, (p, s) in enumerate(zip(right, silent, strict=True)):
        assert abs(rates[1, 2, k] - p * (1 - s)) < 0.03 and abs(rates[0, 1, k] - p * (1 - s)) < 0.05
    best = {k: quality.posterior(k, share, rates) for k in patterns}
    assert best["22222"] > 0.99 and best["11111"] < 0.05


def test_estimates_hang_on_shares_alone():
    patterns = {"22": 700, "11": 200, "20": 60, "12": 40}
    small, large = quality.accuracies(patterns), quality.accuracies({k: n * 10_000 for k, n in patterns.items()})
    assert np.isclose(small[0], large[0]) and np.allclose(small[1], large[1])


def test_ties_are_undecided():
    """Votes that cancel out say nothing; a text of which all heuristics abstain has the share of good texts."""
    patterns = {"21": 50, "12": 50, "22": 50, "11": 50, "00": 10}
    share, rates = quality.accuracies(patterns)
    assert abs(quality.posterior("00", share, rates) - share) < 1e-9
    assert abs(quality.posterior("21", share, rates) - quality.posterior("12", share, rates)) < 1e-6
    assert quality.posterior("22", share, rates) > quality.posterior("21", share, rates) > quality.posterior("11", share, rates)


def test_query_against_plain_code(spark):
    """Votes, estimates, features, training and scores of the query, text by text."""
    sf = "/root/testdata/sf0.001"
    rows = table(spark, sf, "documents").select("doc_id", "text", F.xxhash64("doc_id", F.xxhash64(F.coalesce("text", F.lit("")), F.lit(1)), F.xxhash64(F.coalesce("text", F.lit("")), F.lit(2))).alias("h")).collect()
    got = {r.doc_id: r for r in quality.op3_quality_classifier(spark, sf).collect()}
    cast = {r.doc_id: quality.votes(r.text) for r in rows}
    v = np.array([[int(c) for c in cast[r.doc_id]] for r in rows])
    post = {}
    share, rates = quality.accuracies(dict(Counter(cast.values())))
    for r, own in zip(rows, v, strict=True):  # Bayes' rule among the votes cast
        good, bad = share, 1 - share
        for k, vote in enumerate(own):
            if vote:
                good *= rates[1, vote, k] / rates[1, 1:, k].sum()
                bad *= rates[0, vote, k] / rates[0, 1:, k].sum()
        post[r.doc_id] = good / (good + bad)
    features, w, total = quality.Features(), np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)
    order, rng = sorted(rows, key=lambda r: r.h), np.random.default_rng(3)
    for e in range(12):
        for k in rng.permutation(len(order)):
            at, x = features(order[k].text)
            p = 1 / (1 + np.exp(-np.clip(sum(w[at] * x), -30, 30)))
            for a, c in zip(at, x, strict=True):
                w[a] += 2.0 / (1 + e) * (post[order[k].doc_id] - p) * c
        total += w / 12
    assert set(got) == set(cast)
    for r in rows:
        at, x = features(r.text)
        p = 1 / (1 + np.exp(-np.clip(total[at] @ x, -30, 30)))
        g = got[r.doc_id]
        assert g.votes == cast[r.doc_id] and abs(g.weak_posterior - post[r.doc_id]) < 1e-6
        assert abs(g.score - p) < 1e-3 and (g.keep == (p >= 0.5) or abs(p - 0.5) < 1e-3)


def test_against_held_back_labels(spark):
    got = quality.op3_quality_classifier(spark, SF)
    assert got.columns[:4] == ["doc_id", "score", "predicted", "keep"]
    rows = got.join(table(spark, SF, "labels"), "doc_id").collect()
    good, bad = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.predicted for r in good) / len(good) > 0.98
    assert sum(r.predicted for r in bad) / len(bad) < 0.15
    assert got.count() == table(spark, SF, "documents").count()


def test_odd_rows(spark):
    base = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    odd = [(9001, None), (9002, ""), (9003, " \n "), (None, base[1][1]), (9004, "Fine words here. " * 30000), (9004, "Short."), (9005, "SPAM!! " * 500)]
    docs = spark.createDataFrame([(i, t, "s", True) for i, t in base + odd], "doc_id long, text string, score string, keep boolean")
    got = {}
    for r in quality.quality(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(base) + len(odd) and len(got[9004]) == 2
    assert all(0 <= r.score <= 1 for v in got.values() for r in v)
    assert {got[k][0].votes for k in (9001, 9002, 9003)} == {"1" * len(quality.HEURISTICS)}
    assert got[9005][0].predicted == 0 and got[None][0].score == got[base[1][0]][0].score
    assert quality.quality(docs.limit(0)).count() == 0
