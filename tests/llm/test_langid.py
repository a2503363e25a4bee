import zlib

import numpy as np
from pyspark.sql import functions as F

from duelframe.llm import langid
from duelframe.llm.common import table

SF = "/root/testdata/sf0.01"


def small_net():
    rng = np.random.default_rng(0)
    return langid.ByteConvNet(["a", "b", "c"], rng.normal(size=(256, 4)), [rng.normal(size=(w, 4, 5)) for w in (2, 3, 4)], rng.normal(size=15), rng.normal(size=(15, 3)), rng.normal(size=3))


def test_tables_equal_convolution():
    net = small_net()
    windows = np.random.default_rng(1).integers(0, 256, (7, langid.WINDOW), dtype=np.uint8)
    assert np.allclose(langid.Scorer(net).pooled(windows), net.pooled(windows)[0], atol=1e-4)


def test_windows_cover_the_whole_text():
    net = small_net()
    text = bytes(np.random.default_rng(2).integers(1, 256, langid.WINDOW * langid.STEP * 2 + 77, dtype=np.uint8))
    got = langid.Scorer(net).documents([b"x", text, b"yz"])[1]
    cut = [text[i : i + langid.WINDOW] for i in range(0, len(text), langid.WINDOW)]
    w = np.array([list(c.ljust(langid.WINDOW, b"\0")) for c in cut], np.uint8)
    p = net.probabilities(net.pooled(w)[0]) * np.array([len(c) for c in cut])[:, None]
    assert np.allclose(got, p.sum(0) / len(text), atol=1e-4)


def test_query_against_plain_code(spark):
    """The trained network by its definition, window by window and text by text."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    net = langid.fit(docs.where("crc32(cast(doc_id as string)) % 3 <> 1"))
    got = {r.doc_id: r for r in langid.op10_language_id(spark, sf).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert set(got) == set(texts) and net.languages == sorted({r.lang for r in docs.collect() if r.lang})
    for i, text in texts.items():
        data = (text or "").encode()
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        if not any(map(str.isalpha, text or "")):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        total = np.zeros(len(net.languages))
        for at in range(0, len(data), 256):
            part = data[at : at + 256]
            x = net.embed[list(part.ljust(256, b"\0"))]
            tops = [max((x[k : k + len(c)].reshape(-1) @ c.reshape(-1, c.shape[2]) for k in range(257 - len(c))), key=lambda y, f=f: y[f])[f] for c in net.convs for f in range(c.shape[2])] if at < 512 else net.pooled(np.array([list(part.ljust(256, b"\0"))], np.uint8))[0][0]
            z = np.maximum(np.array(tops) + net.bias, 0) @ net.dense + net.offset
            total += len(part) * np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        total /= len(data)
        assert abs(got[i].score - total.max()) < 1e-3 and total[net.languages.index(got[i].lang_pred)] > total.max() - 1e-3


def test_more_languages_than_two_hundred(spark):
    """Every label is learned, from fewer texts each; the rule for what is kept is the same."""
    rng = np.random.default_rng(3)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = ["".join(rng.choice(list(letters), 5)) for _ in range(230)]
    rows = [(i, " ".join("".join(rng.choice(list(own[i % 230]), 4)) for _ in range(30)), f"l{i % 230:03}") for i in range(230 * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.language_id(docs, most_docs=1).join(docs, "doc_id").where("held_out").collect()
    assert len({r.lang_pred for r in got}) > 150
    assert sum(r.lang_pred == r.lang for r in got) > 0.4 * len(got)
    assert np.isclose(langid.least_score(4, 1 / 15), 0.3) and langid.least_score(1, 0.1) == 1 and langid.least_score(1000, 1 / 15) < 0.07


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = langid.op10_language_id(spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97


def test_odd_rows(spark):
    base = table(spark, SF, "documents").limit(60).select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(900001, None, "en"), (900002, "", "en"), (900003, "123 $$ 456", "en"), (None, "the and of the tion", None), (900004, "the and ther tion " * 20000, None), (900004, "x", "en")], "doc_id long, text string, lang string")
    docs = base.unionByName(odd).withColumn("score", F.lit("clash")).withColumn("_found", F.lit(1))
    got = {}
    for r in langid.language_id(docs).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for k in (900001, 900002, 900003):
        assert got[k] == [("und", 0.0)]
    assert len(got[900004]) == 2 and all(x[0] != "und" for x in got[900004])
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert not {900001, 900002, 900003} & {r.doc_id for r in rows}
    assert {(r.score, r._found) for r in rows} == {("clash", 1)}
    assert langid.language_id(docs.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.language_id(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
