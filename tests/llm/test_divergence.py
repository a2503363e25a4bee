import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from duelframe.llm import divergence
from duelframe.llm.common import table

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least=3, top=200):
    """rows of (lang, source, text) -> sorted (lang, source, part, item, value, rank), every share computed for every term."""
    docs, words, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, text = lang or "", source or "", text or ""
        found = TERM.findall(text.translate(LOWER))
        groups[lang].add(source)
        docs[lang].update(set(found))
        words[lang, source].update(found)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 1) // (total + len(kept)) for t in kept}

        p = {s: shares(words[lang, s]) for s in sources}
        q = shares(sum((words[lang, s] for s in sources), Counter()))
        gap = lambda x, y: (x - y) ** 2 // y
        for s in sources:
            pairs = sorted((-sum(gap(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            told = sorted((-gap(p[s][t], q[t]), t.encode()) for t in kept if words[lang, s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item.decode(), -v, rank) for part, found in (("pair", pairs), ("term", told)) for rank, (v, item) in enumerate(found, 1)]
    return sorted(out)


def audited(spark, rows, **kw):
    frame = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3).withColumns({c: F.lit("c") for c in ("term", "n", "value", "rank", "p", "kept", "total", "part", "item")})
    return sorted(tuple(r) for r in divergence.audit(frame, **kw).collect())


def made(n=400):
    rng = random.Random(13)
    vocabulary = ["The", "the", "É", "é", "日本語", "a1b", "x-y", "KK"] + [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(200)]
    text = lambda: "".join(rng.choice(vocabulary[: rng.choice([5, 50, 208])]) + rng.choice([" ", "\n", ".", "1", "\x7f"]) for _ in range(rng.randint(0, 40)))
    rows = [(rng.choice(["en", "en", "de", None, ""]), rng.choice(["hot", "hot", "hot", "a", "b", "é", None]), text()) for _ in range(n)]
    return rows + [("en", "none", None), ("en", "none", "1 2 3"), ("fr", "x", "only two docs"), ("fr", "y", "only two docs"), ("it", "alone", "uno uno uno"), ("it", "alone", "uno"), ("it", "alone", "uno due")] + [("en", "a", "same same same")] * 20


def test_against_every_share_of_every_term(spark, monkeypatch):
    rows = made()
    want = brute(rows)
    assert {r[2] for r in want} == {"pair", "term"} and any(r[0] == "fr" and r[4] == 0 for r in want)
    assert audited(spark, rows, bits=14) == want
    assert audited(spark, rows, bits=14, min_docs=1, top=5) == brute(rows, 1, 5)
    monkeypatch.setattr(divergence, "lean", lambda df: df)  # tables too large to broadcast
    assert audited(spark, rows, bits=14) == want


def test_small_tables(spark):
    assert audited(spark, []) == []
    assert audited(spark, [(None, None, None)]) == []
    assert audited(spark, [("en", "a", None), ("en", "b", "x")]) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    long = "word " * 400_000
    rows = [("en", "a", long), ("en", "b", "word other"), ("en", "b", "word other"), ("en", "c", "other")]
    assert audited(spark, rows) == brute(rows)


def test_shares_beyond_64_bits(spark):
    cases = [(0, 5), (4, 5), (2**53, 2**54 + 1), (9_223_372_035, 9_223_372_036), (9_223_372_036, 9_223_372_037), (10**17, 10**18)]
    got = spark.createDataFrame(cases, "n long, total long").select(divergence.share(F.col("n"), F.col("total"))).collect()
    assert [r[0] for r in got] == [1 + 10**9 * (n + 1) // total for n, total in cases]


def test_flushes_change_nothing():
    """A task that holds little hands on the same counts, in more rows."""
    import pyarrow as pa

    class All:
        value = staticmethod(lambda table, h: h == h)

    rows = [(lang or "", source or "", (text or "").encode()) for lang, source, text in made(60)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["lang", "source", "text"])
    seen = []
    for held in (3, 10**6):
        divergence.HELD, old = held, divergence.HELD
        try:
            found = defaultdict(lambda: [0, 0])
            n = 0
            for part in divergence._count(All)(iter([batch])):
                for lang, source, term, words, docs in zip(*(c.to_pylist() for c in part.columns)):
                    found[lang, source, term][0] += words
                    found[lang, source, term][1] += docs
                    n += 1
            seen.append((dict(found), n))
        finally:
            divergence.HELD = old
    assert seen[0][0] == seen[1][0] and seen[0][1] > seen[1][1]


def test_query(spark):
    d = "/root/testdata/sf0.001"
    rows = [(r.lang, r.source, r.text) for r in table(spark, d, "documents").collect()]
    assert sorted(tuple(r) for r in divergence.op13_source_divergence(spark, d).collect()) == brute(rows)
