import random

import public_tokenizers
from tokenizers import Tokenizer

from duelframe.llm import tokencount
from duelframe.llm.common import table

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.01"


def library(texts):
    t = Tokenizer.from_file(PATH)
    return [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]


def test_pre_tokens_against_the_library():
    rng = random.Random(5)
    pool = list("aZ é É İ ß ǆ 'sdtl 0½ ² \t\n  ᰟ\x1c\x1f ́ é ﬁ 漢字 ไทย 👩‍👩‍👧 Σ ς !?<|>#_") + ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "'re", "'LL", "don't", "''s"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    t = tokencount.PreTokens(PATH)
    for text, n in zip(texts, library(texts), strict=True):
        counts, special = t.frequencies(text)
        assert special + sum(c * p for c, p in zip(counts.values(), t.pieces(list(counts)), strict=True)) == n, repr(text)


def differing(texts):
    """Texts that the library counts otherwise, as code points."""
    t = tokencount.PreTokens(PATH)
    found = [t.frequencies(x) for x in texts]
    every = sorted({p for counts, _ in found for p in counts})
    known = dict(zip(every, t.pieces(every), strict=True))
    mine = [special + sum(c * known[p] for p, c in counts.items()) for counts, special in found]
    return [[hex(ord(c)) for c in x] for x, m, n in zip(texts, mine, library(texts), strict=True) if m != n]


def test_every_code_point_against_the_library():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert differing([" ".join(f"{c} a{c}b" for c in points[k : k + 64]) for k in range(0, len(points), 64)]) == []


def test_marks_that_lower_case_reorders():
    rng = random.Random(9)
    pool = list("\u0130\u0307\u0327\u0323\u0301\u0345\u1100\u1161\u11a8\uac00\u03a3\u03c2aZ i\u0131'9 ") + ["<|endoftext|>", "<|startoftext|>", "\u212b", "\u1e9b\u0323"]
    assert differing(["\u0130\u0327"] + ["".join(rng.choice(pool) for _ in range(rng.randint(1, 12))) for _ in range(100_000)]) == []


def test_query_against_the_library(spark):
    docs = table(spark, SF, "documents").collect()
    want = {d.doc_id: (len((d.text or "").encode()), n, n > 2048) for d, n in zip(docs, library([d.text or "" for d in docs]), strict=True)}
    got = tokencount.op5_token_counts(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    few = tokencount.count_tokens(table(spark, SF, "documents"), PATH, frequent=50)
    assert {r.doc_id: tuple(r)[1:] for r in few.collect()} == want


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b <|endoftext|> a"), (4, "a b <|endoftext|> a"), (4, "other"), (None, "x y"), (None, "x y"), (5, "word's " * 60000)]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "doc_id long, text string, token string, n int")
    got = sorted((tuple(r) for r in tokencount.count_tokens(docs, PATH, frequent=3).collect()), key=str)
    want = sorted(((i, len((x or "").encode()), n, n > 2048) for (i, x), n in zip(rows, library([x or "" for _, x in rows]), strict=True)), key=str)
    assert got == want
    assert tokencount.count_tokens(docs.limit(0), PATH).count() == 0
