import math
import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from duelframe.llm import toxicity as tox
from duelframe.llm.common import table

SF = "/root/testdata/sf0.1"


def brute_segments(w):
    """Ruzzo and Tompa's recursive definition: the best contiguous run, then the same left and right of it."""
    if not len(w):
        return []
    best = max(((sum(w[a:b]), -(b - a), -a, a, b) for a in range(len(w)) for b in range(a + 1, len(w) + 1)), default=None)
    if best[0] <= 1e-9:
        return []
    _, _, _, a, b = best
    return brute_segments(w[:a]) + [(a, b, best[0])] + [(x + b, y + b, s) for x, y, s in brute_segments(w[b:])]


def test_segments_against_definition():
    rng = random.Random(4)
    for _ in range(300):
        w = [rng.choice([-3, -2, -1, 1, 2, 5]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = tox.segments(np.array(w))
        want = brute_segments(w)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in want]
        assert np.allclose([s for *_, s in got], [s for *_, s in want])


def test_passages():
    lexicon = tox.Lexicon({"bad": 8.0}, {"awful": 8.0}, -0.2, 0.3)
    text = "good " * 30 + "Bad thing BAD" + " good" * 60 + " awfully"
    spans = tox.passages(text, lexicon)
    assert [text[a:b] for a, b, _ in spans] == ["Bad thing BAD", "awfully"]
    assert tox.passages(None, lexicon) == tox.passages("", lexicon) == tox.passages("fine", lexicon) == []


def test_held_out_accuracy(spark):
    got = tox.op4_toxicity(spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    assert got.count() == table(spark, SF, "documents").count()
    hits = sum(r.predicted for r in rows if r.toxic == 1) / sum(r.toxic == 1 for r in rows)
    wrong = sum(r.predicted for r in rows if r.toxic == 0) / sum(r.toxic == 0 for r in rows)
    assert hits > 0.85 and wrong < 0.03


def test_query_against_plain_code(spark, tmp_path):
    """Every step of the query over a small fixture: counts, log-odds, segments by their definition, the law, the curve."""
    docs = [(r.doc_id, " ".join((r.text or "").split()[:30])) for r in table(spark, "/root/testdata/sf0.01", "documents").limit(500).collect()]
    docs = [(i, f"{text} {('grobian', 'lumpenhund', 'tropf')[i % 3]} {text[:20]}" if i % 4 == 1 or i % 17 == 2 else text) for i, text in docs]
    labels = [(i, int(i % 4 == 1)) for i, _ in docs if i % 7] + [(docs[9][0], 1)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in tox.op4_toxicity(spark, str(tmp_path)).collect()}

    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in docs}
    toxic = {}
    for i, y in labels:
        if not held[i]:
            toxic[i] = max(y, toxic.get(i, 0))
    words = {i: re.findall(r"[^\W_]+", text.lower()) for i, text in docs}
    counts = {0: defaultdict(lambda: [0, 0]), 1: defaultdict(lambda: [0, 0])}
    for i, y in toxic.items():
        for kind, terms in ((0, set(words[i])), (1, {w[:5] for w in words[i] if len(w) > 5})):
            for t in terms:
                counts[kind][t][1 - y] += 1
    score = {}
    for kind, terms in counts.items():
        n1, n0 = (sum(c[k] for c in terms.values()) for k in (0, 1))
        for t, (c1, c0) in terms.items():
            a, b = 0.1 * (c1 + c0), 0.1 * (n1 + n0)
            delta = math.log((c1 + a) / (n1 + b - c1 - a)) - math.log((c0 + a) / (n0 + b - c0 - a))
            score[kind, t] = delta * 2 / (2 + 1 / (c1 + a) + 1 / (c0 + a)) - 1.2
    weight = lambda w: score.get((0, w), score.get((1, w[:5]), -1.2) if len(w) > 5 else -1.2)
    found = {i: brute_segments([weight(w) for w in ws]) for i, ws in words.items()}
    clean = [(max((s for *_, s in found[i]), default=0.0), len(words[i])) for i, y in toxic.items() if not y]
    rows = [(s, n) for s, n in clean if s > 0]
    assert len(rows) >= tox.LEAST_TEXTS

    def likelihood(x):
        k = len(rows) / sum(n * math.exp(-x * s) for s, n in rows)
        return sum(math.log(x * k) - x * s for s, _ in rows), x, k

    _, rate, k = max(map(likelihood, tox.RATES))

    def evidence(i):
        if not found[i]:
            return -12.0
        scores = [rate * s - math.log(k * len(words[i])) for *_, s in found[i]]
        good = [s for s in scores if s > -math.log(0.05)]
        return min(40.0, max(-12.0, max(scores), sum(good) if good else -12.0))

    seen = {i: evidence(i) for i in words}
    x = np.array([math.copysign(math.floor(abs(seen[i]) * 8 + 0.5) / 8, seen[i]) for i in toxic])
    y = np.array(list(toxic.values()), float)
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)])
    for _ in range(500):
        p = 1 / (1 + np.exp(-(w @ design)))
        curved = (design * (p * (1 - p) * 100 / len(y))) @ design.T + 0.01 * np.eye(2)
        w = w - 0.2 * np.linalg.solve(curved, design @ (p - y) * 100 / len(y) + 0.01 * w)
    want = {i: 1 / (1 + math.exp(-(w[0] * e + w[1]))) for i, e in seen.items()}
    assert {i: r.held_out for i, r in got.items()} == held
    off = [(i, v, got[i].score, seen[i], got[i].best, got[i].passages) for i, v in want.items() if abs(got[i].score - v) > 0.01 or abs(v - 0.5) > 0.01 and got[i].predicted != int(v >= 0.5)]
    assert off == [], (len(off), w, rate, k)
    assert sum(r.predicted for r in got.values()) > 50


def test_few_labels_are_a_bounded_choice(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    few = tox._marks(labels, "doc_id", "toxic", F.col("id") % 3 != 0, 100).collect()
    assert 60 < len(few) < 150 and all(r.id % 3 and r.toxic == r.id % 2 for r in few)
    assert len(tox._marks(labels, "doc_id", "toxic", F.lit(True), 10_000).collect()) == 3001


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(i, f"word{i % 7} plain text here {'idiot moron' if i % 3 == 0 else 'fine day'} tail{i % 5}", "x", "y") for i in range(300)]
        + [(1000, None, "x", "y"), (1001, "", "x", "y"), (1002, "!!! ???", "x", "y"), (None, "idiot moron", "x", "y"), (1003, "calm words " * 50000 + "idiot moron idiot moron", "x", "y"), (1003, "calm", "x", "y")],
        "doc_id long, text string, toxic string, evidence string",
    )
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)] + [(0, 1), (0, 0), (5, None), (None, 1)], "doc_id long, toxic int")
    rows = tox.toxicity(docs, labels).collect()
    assert len(rows) == 306 and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert {by[k][0].predicted for k in (1000, 1001, 1002)} == {0}
    assert by[None][0].predicted == 1 and by[None][0].held_out is False
    assert sorted(r.predicted for r in by[1003]) == [0, 1]
    assert all(by[i][0].predicted == int(i % 3 == 0) for i in range(300))
    kept = tox.keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i in range(300) if i % 3} | {1000, 1001, 1002, 1003}
    assert tox.toxicity(docs.limit(0), labels).count() == 0
    assert {r.predicted for r in tox.toxicity(docs, labels.limit(0)).select("predicted").distinct().collect()} == {0}


def test_every_counted_token_has_its_own_score(spark):
    """Moderately toxic and typically clean words score by their log-odds; none falls under a cutoff."""
    rows = [(i, "mild " * (i % 2 == 0 or i % 10 == 1) + "nice " * (i % 2 == 1) + f"both w{i}", int(i % 2 == 0)) for i in range(200)]
    lexicon = tox.fit_lexicon(spark.createDataFrame(rows, "id long, text string, toxic int"))
    assert len(lexicon.words) == 203
    assert lexicon.weight("nice") < lexicon.weight("w1") < lexicon.weight("both") < lexicon.weight("w2") < lexicon.weight("mild")
    assert lexicon.weight("mild") > lexicon.other + 0.8 and lexicon.weight("nice") < lexicon.other - 0.8


def test_law_of_clean_segments(spark):
    rng = np.random.default_rng(8)
    n = rng.integers(50, 2000, 5000)
    best = (np.log(0.02 * n) - np.log(-np.log(rng.random(5000)))) / 1.7
    rate, k = tox.fit_law(spark.createDataFrame([(float(s), int(m)) for s, m in zip(best, n, strict=True) if s > 0], "best double, tokens long"))
    assert abs(rate - 1.7) < 0.2 and 0.01 < k < 0.04


def test_terms_that_are_not_held_change_nothing(spark):
    """The driver holds a bounded number of terms; results are those of all terms."""
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    docs = docs.unionByName(docs.limit(20)).withColumns({"found": F.lit("x"), "key_a": F.lit(1)})
    train = tox.materialize(tox._labelled(docs, tox._marks(labels, "doc_id", "toxic", F.lit(True), 1000), "doc_id", "text"))
    whole, part = tox.fit_lexicon(train, in_place=1 << 20), tox.fit_lexicon(train, in_place=60)
    assert whole.top is None and len(whole.words) > 10_000
    assert part.top is not None and len(part.words) + len(part.stems) <= 60
    assert part.rate == whole.rate and np.isclose(part.k, whole.k)
    got = [sorted(map(tuple, tox.scan_documents(docs, x).collect())) for x in (whole, part)]
    assert len(got[0]) == docs.count() and any(r[3] for r in got[0])
    assert [r[0] for r in got[0]] == [r[0] for r in got[1]] and np.allclose(got[0], got[1])
    kept = tox.keep_clean(docs, labels, in_place=60)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(tox.keep_clean(docs, labels).collect())
