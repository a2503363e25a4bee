import random
import time
import tracemalloc

import numpy as np

from duelframe.llm import decontam
from duelframe.llm.common import table


def brute_tiles(doc, item, least):
    """Wise's greedy string tiling, by comparing all positions for every tile."""
    used_d, used_i, out = set(), set(), []
    while True:
        best = (least - 1, 0, 0)
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and p + n not in used_d and q + n not in used_i:
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < least:
            return out
        out.append((p, q, n))
        used_d |= set(range(p, p + n))
        used_i |= set(range(q, q + n))


def test_tiles_against_brute_force():
    rng = random.Random(6)
    for _ in range(150):
        doc = np.array([rng.randint(1, 3) for _ in range(rng.randint(0, 40))])
        item = np.array([rng.randint(1, 3) for _ in range(rng.randint(5, 20))])
        least = rng.choice([1, 2, 5])
        assert decontam.tile(doc, item, least) == brute_tiles(doc.tolist(), item.tolist(), least)


def test_equal_tokens_on_both_sides():
    """No pair of positions is held: 20,000 equal words on both sides take little time and memory."""
    same = np.ones(20_000, int)
    tracemalloc.start()
    began = time.perf_counter()
    assert decontam.tile(same, same) == [(0, 0, 20_000)]
    assert decontam.tile(same, same[:1600]) == [(0, 0, 1600)]
    turns = np.tile([1, 2, 1, 1, 3], 4000)
    assert sum(n for *_, n in decontam.tile(turns, np.roll(turns, 2))) == 19_998
    assert time.perf_counter() - began < 10 and tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()


def brute_leaks(docs, items):
    """{(doc, item): matched tokens} of all pairs."""
    out = {}
    for d, text in docs:
        words = decontam.tokens(text)
        for i, other in items:
            item = decontam.tokens(other)
            n = sum(n for *_, n in brute_tiles(words, item, min(5, len(item)))) if item and set(item) & set(words) else 0
            if item and n >= 0.8 * len(item) - 1e-9:
                out[d, i] = n
    return out


def test_items_and_texts_that_share_many_windows(spark, monkeypatch):
    """Items of 1 token and more, passages that most texts and items have, a full bitmap: as by all pairs."""
    rng = random.Random(16)
    common = [" ".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(3)]
    rare = lambda n: " ".join(f"w{rng.randint(1, 60)}" for _ in range(n))
    part = lambda: rng.choice(common) if rng.random() < 0.6 else rare(rng.randint(1, 12))
    items = [(k, " ".join(part() for _ in range(rng.randint(1, 3)))) for k in range(40)] + [(100, "w7"), (101, "w8 w9"), (102, common[0]), (103, f"{common[1]} w1 w2 w3")]
    docs = [(k, " ".join([part() for _ in range(rng.randint(0, 5))] + rng.sample([items[rng.randrange(40)][1], rare(9)], 2))) for k in range(60)]
    want = brute_leaks(docs, items)
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert len(want) > 200 and {i for _, i in want} >= {100, 102}
    assert {(r.doc_id, r.item_id): r.matched_tokens for r in decontam.leaks(*frames).collect()} == want
    monkeypatch.setattr(decontam, "MOST_BITS", 16)
    monkeypatch.setattr(decontam, "BITS_EACH", 0)
    monkeypatch.setattr(decontam, "ROW_BYTES", 64)
    assert {(r.doc_id, r.item_id): r.matched_tokens for r in decontam.leaks(*frames).collect()} == want


def test_short_items_and_scripts_without_spaces(spark):
    docs = [(1, "alpha beta gamma delta and alpha beta gamma delta"), (2, "alpha beta gamma and delta"), (3, "今日は、東京の天気がとても良いです。"), (4, "東京 の 天気 と 水"), (5, "Yes")]
    items = [(1, "alpha beta gamma delta"), (2, "東京の天気がとても良い"), (3, "YES!"), (4, "...")]
    got = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.matched_tokens) for r in got) == [(1, 1, 4), (3, 2, 11), (5, 3, 1)]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: decontam.tokens(r.text) for r in table(spark, sf, "documents").collect()}
    items = {r.item_id: decontam.tokens(r.text) for r in table(spark, sf, "benchmark").collect()}
    got = {(r.doc_id, r.item_id): r.matched_tokens for r in decontam.op6_decontamination(spark, sf).collect()}
    want = {}
    grams = {i: {tuple(x[k : k + 5]) for k in range(len(x) - 4)} for i, x in items.items()}
    for d, words in docs.items():
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        for i, item in items.items():
            if own & grams[i]:
                n = sum(n for *_, n in brute_tiles(words, item, 5))
                if n >= 0.8 * len(item):
                    want[d, i] = n
    assert got == want and want


def test_reordered_passages_and_odd_rows(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    turned = "Seven, eight nine TEN eleven twelve. noise one two three four five six"
    docs = spark.createDataFrame(
        [(1, "x " * 100000 + item + " y", "c"), (2, turned, "c"), (3, "one two three four five", "c"), (4, None, "c"), (5, "", "c"), (None, item, "c"), (6, item, "c"), (6, item, "c")],
        "doc_id long, text string, coverage string",
    )
    bench = spark.createDataFrame([(10, item, 1), (10, item, 2), (11, None, 1), (12, "two one", 1), (None, item, 1)], "item_id long, text string, tiles int")
    got = [(r.doc_id, r.item_id, r.coverage, r.tiles) for r in decontam.leaks(docs, bench).collect()]
    assert sorted(got, key=str) == sorted([(1, 10, 1.0, 1), (2, 10, 1.0, 2), (None, 10, 1.0, 1), (6, 10, 1.0, 1), (6, 10, 1.0, 1)], key=str)
    kept = decontam.keep_uncontaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5]
    assert decontam.leaks(docs.limit(0), bench).count() == 0 and decontam.leaks(docs, bench.limit(0)).count() == 0
    assert decontam.keep_uncontaminated(docs, bench.limit(0)).count() == 8
