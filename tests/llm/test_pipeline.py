"""The pipeline's stages, each on what the one before it kept, against plain code on the same rows."""

import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from test_decontam import brute_tiles
from test_mixing import targets
from test_simhash import brute_components, brute_print

import corpus_pipeline
from duelframe.llm import decontam, langid, toxicity
from duelframe.llm.common import materialize, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """What goes into each stage, and comes out of the last."""
    docs = [table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], SF)))
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns_stay(kept):
    for df in kept[:-1]:
        assert df.columns == kept[0].columns
        before = rows(kept[0])
        assert all(tuple(r) == tuple(before[i]) for i, r in rows(df).items())


def test_languages(kept):
    net = langid.fit(kept[0].where("crc32(cast(doc_id as string)) % 3 <> 1"))
    scorer = langid.Scorer(net)
    want = {i for i, r in rows(kept[0]).items() if r.text and any(map(str.isalpha, r.text)) and scorer.documents([r.text.encode()]).max() >= 0.3}
    assert set(rows(kept[1])) == want and len(want) > 190


def test_toxicity(spark, kept):
    labels = {r.doc_id: r.toxic for r in table(spark, SF, "labels").where("toxic is not null").collect()}
    docs = rows(kept[1])
    learn = {i for i in docs if i in labels and zlib.crc32(str(i).encode()) % 5}
    assert learn
    train = toxicity._labelled(kept[1], toxicity._marks(table(spark, SF, "labels"), "doc_id", "toxic", F.expr("crc32(cast(id as string)) % 5 <> 0"), 1000), "doc_id", "text")
    assert sorted((r.id, r.toxic) for r in train.collect()) == sorted((i, labels[i]) for i in learn)
    lexicon = toxicity.fit_lexicon(train)
    scanned = toxicity.scan_documents(train, lexicon, "id", "text").select("id", "evidence").join(train.select("id", "toxic"), "id")
    slope, offset = toxicity.fit_calibration(scanned)
    want = {i for i, r in docs.items() if slope * toxicity.scan(r.text, lexicon)[0] + offset < 0}
    assert set(rows(kept[2])) == want


def test_near_duplicates(kept):
    docs = rows(kept[2])
    comp = brute_components([(i, brute_print(r.text)) for i, r in docs.items()])
    assert set(rows(kept[3])) == set(comp.values()) and len(set(comp.values())) < len(docs)


def test_decontamination(spark, kept):
    items = [decontam.tokens(r.text) for r in table(spark, SF, "benchmark").collect()]
    grams = [{tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in items]
    want = set()
    for i, r in rows(kept[3]).items():
        words = decontam.tokens(r.text)
        own = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        if not any(own & g and sum(n for *_, n in brute_tiles(words, x, 5)) >= 0.8 * len(x) for x, g in zip(items, grams, strict=True)):
            want.add(i)
    assert set(rows(kept[4])) == want


def test_mix(kept):
    docs, got = rows(kept[4]), rows(kept[5])
    size, taken = defaultdict(int), defaultdict(int)
    for r in docs.values():
        size[r.source] += len((r.text or "").encode().split())
    names = sorted(size)
    goals = dict(zip(names, targets([size[k] for k in names], [(3, 1, 2)[k % 3] for k in range(len(names))], 1.5 * sum(size.values())), strict=True))
    for i, r in got.items():
        assert r.source == docs[i].source and 0 < r.taken <= 2 * r.size and r.source_size == size[r.source] and r.target == pytest.approx(goals[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[k] - goals[k]) <= 1 for k in names)


def test_run_is_all_stages(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, kept[5].collect()))


def test_odd_documents_pass_every_stage(spark):
    base = table(spark, SF, "documents").limit(80)
    odd = spark.createDataFrame(
        [(900001, None, None, None, None), (900002, "", "en", "s", 0), (None, "the and of the tion ing", None, None, None), (900003, "the and of that thing " * 30000, "en", None, 1), (900004, "the and of that", "en", "s", 1), (900004, "the and of that", "en", "s", 1), (900005, "12 34 !!", "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    extra = base.unionByName(odd).withColumns({"repeats": F.lit("a"), "_repeats": F.lit(1), "row": F.lit("b"), "toxic": F.lit(None).cast("string"), "h": F.lit(2.5), "size": F.lit("x"), "id": F.lit("y"), "label": F.lit("z"), "k": F.lit(0)})
    for docs in (extra, extra.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            got = out.collect()
            if name != "source_mixing":
                assert out.columns == docs.columns
                assert all(r.repeats == "a" and r.row == "b" and r.size == "x" and r.id == "y" for r in got)
            assert bool(got) == (docs is extra), name
