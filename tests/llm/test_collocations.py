import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from duelframe.llm import collocations
from duelframe.llm.common import table

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=30, top=2000, most=4):
    """rows of (lang, text) -> sorted (lang, rank, phrase, a, l, r, n, score)."""
    freq, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall(r"[^ \t]+", piece)
            total[lang] += len(words)
            for k in range(1, most + 1):
                freq[lang].update(tuple(words[s : s + k]) for s in range(len(words) - k + 1))
    out = []
    for lang, f in freq.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    inside[p[s : s + m]] = max(inside[p[s : s + m]], a)
        kept = []
        for p, a in cand.items():
            if p in inside and 100 * inside[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, total[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], 1)]
    return sorted(out)


def mined(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "lang string, text string").repartition(3).withColumns({"phrase": F.lit("p"), "k": F.lit(0), "f": F.lit(1), "n": F.lit(2)})
    return sorted(tuple(r) for r in collocations.collocations(frame, bits=14, **kw).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    vocabulary = ["a", "b", "É", "the", "x\x00y", "z'z", " ", "Q", "日本", "w1", "w2"] + [f"r{k}" for k in range(60)]
    text = lambda n: "".join(rng.choice(vocabulary[: rng.choice([4, 11, 71])]) + rng.choice([" ", "  ", "\t", " ", " ", ", ", ".", "\n", "! "]) for _ in range(n))
    out = [(rng.choice(["en", "de", None, "und", ""]), text(rng.randint(0, 80))) for _ in range(300)]
    return out + [("en", "one two three four five") for _ in range(40)] + [("en", "ONE TWO Three")] * 5 + [("de", "go go " * 200), ("en", None), (None, None), ("fr", "only once"), ("en", " ,.;\t")]


def test_against_plain_counts(spark, rows, monkeypatch):
    want = brute(rows)
    assert len(want) > 15 and {r[0] for r in want} >= {"en", "de", "und"}
    assert mined(spark, rows) == want
    assert mined(spark, rows, min_count=3, top=7, most=3) == brute(rows, 3, 7, 3)


def test_slices_and_small_memories_change_nothing(spark, rows):
    """In a session's workers the limits are constants, so the passes are run here as tasks run them."""
    import pandas as pd

    few = [(lang or "und", (t or "").encode()) for lang, t in rows[:120]]
    want = Counter()
    for lang, t in few:
        for piece in re.split(rb"[.,;:!?\n-\r]", t.lower()):
            words = re.findall(rb"[^ \t]+", piece)
            want.update((lang, k, b" ".join(words[s : s + k])) for k in range(1, 5) for s in range(len(words) - k + 1))
    for size in (1, 7, 50, 10**6):
        got = Counter()
        for lang, texts in pd.DataFrame(few, columns=["lang", "text"]).groupby("lang")["text"]:
            known = collocations._Ids(lang)
            for words, old in collocations.word_runs(texts, size):
                ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
                for k, phrases, counts in collocations.counted(words, ids, np.array(known.hashes, np.uint64), old, 4, lambda table, h: np.ones(len(h), bool)):
                    got.update({(lang, k, p): n for p, n in zip(phrases, counts.tolist())})
        assert got == want, size


def test_a_sketch_loses_nothing(spark):
    """With far too few cells everything passes; with enough, little but what is frequent."""
    rng = np.random.default_rng(4)
    keys, counts = rng.integers(0, 1 << 63, 50_000).astype(np.uint64), np.minimum(rng.zipf(1.3, 50_000), 500)
    for bits, most in ((14, 50_000), (20, int((counts >= 30).sum() * 1.1))):
        sketches = [collocations.CountMin(30, 2, 2, bits) for _ in range(3)]
        for k, c in zip(range(3), np.array_split(np.arange(50_000), 3)):
            every = np.repeat(keys, counts)[k::3]
            sketches[k].add(1, collocations.mixed(every))
        pages = spark.createDataFrame([r for s in sketches for p in s.pages() for r in p.itertuples(index=False, name=None)], "place int, cells binary").repartition(5)
        reached = collocations.merge(pages, 30, 2, 2, bits)
        passed = reached(1, collocations.mixed(keys))
        assert passed[counts >= 30].all() and passed.sum() <= most
        assert not reached(0, collocations.mixed(keys)).any()


def test_scores_beyond_64_bits(spark):
    a, parts = 2**62, 2**62 + 12345
    got = spark.createDataFrame([(a, parts), (5, 10)], "a long, parts long").select(collocations._score(F.col("a"), F.col("parts"))).collect()
    assert [r[0] for r in got] == [2_000_000 * a // parts, 1_000_000]


def test_empty_tables_and_long_words(spark):
    assert mined(spark, []) == [] and mined(spark, [("en", None), (None, "")]) == []
    long = "x" * 3_000_000
    assert mined(spark, [("en", f"{long} b " * 2 + ".")] * 3, min_count=3) == brute([("en", f"{long} b " * 2 + ".")] * 3, 3)
    with pytest.raises(ValueError):
        mined(spark, [], most=5)


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in table(spark, d, "documents").collect()]
    assert sorted(tuple(r) for r in collocations.op12_phrase_collocations(spark, d).collect()) == brute(rows)
