"""Language identification with a byte convolutional network.

The network embeds bytes, convolves them at several widths, takes each filter's
maximum over a window, and ends in a softmax over the languages. It is trained in
numpy on windows of a bounded sample of labelled texts. Texts of any length are cut
in windows of a fixed length, none left out, and the windows' probabilities are
averaged by the bytes they hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from duelframe.llm.common import id_bucket, lean, materialize, table, text_hash, unit, unused

WINDOW = 256
WIDTHS = (2, 3, 4)
#: Windows that one step convolves together.
STEP = 256
UNDETERMINED = "und"


@dataclass
class ByteConvNet:
    languages: list[str]
    embed: np.ndarray  # 256 x dims
    convs: list[np.ndarray]  # per width: width x dims x filters
    bias: np.ndarray  # all filters
    dense: np.ndarray  # all filters x languages
    offset: np.ndarray  # languages

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each filter's maximum over a window, and where it is; as the definition says, for training."""
        x = self.embed[windows]
        tops, places = [], []
        for kernel in self.convs:
            w, d, f = kernel.shape
            n = x.shape[1] - w + 1
            y = sum(x[:, k : k + n].reshape(-1, d) @ kernel[k] for k in range(w)).reshape(len(x), n, f)
            place = y.argmax(axis=1)
            places.append(place)
            tops.append(np.take_along_axis(y, place[:, None], 1)[:, 0])
        return np.concatenate(tops, axis=1), places

    def probabilities(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled + self.bias, 0) @ self.dense + self.offset
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


class Scorer:
    """A trained network with its convolutions folded into tables.

    A convolution over embedded bytes is a sum of one vector for each byte, so two
    neighbouring bytes' vectors are looked up at once by their 16-bit value.
    """

    def __init__(self, net: ByteConvNet):
        self.net = net
        f = net.convs[0].shape[2]
        one = [[net.embed @ kernel[k] for k in range(len(kernel))] for kernel in net.convs]
        pair = lambda a, b: (a[:, None] + b[None]).reshape(65536, f)
        (a0, a1), (b0, b1, b2), (c0, c1, c2, c3) = one
        self.pairs = np.concatenate([pair(a0, a1), pair(b0, b1), pair(c0, c1), pair(c2, c3)], axis=1).astype(np.float32)
        self.third = b2.astype(np.float32)
        self.f = f

    def pooled(self, windows: np.ndarray) -> np.ndarray:
        n, w = windows.shape
        f = self.f
        index = windows[:, :-1].astype(np.int32) << 8 | windows[:, 1:]
        g = self.pairs[index]
        three = g[:, : w - 2, f : 2 * f]
        three += self.third[windows[:, 2:]]
        four = g[:, : w - 3, 2 * f : 3 * f]
        four += g[:, 2:, 3 * f :]
        return np.concatenate([g[:, :, :f].max(axis=1), three.max(axis=1), four.max(axis=1)], axis=1)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of each text; texts have a byte at least."""
        out = np.zeros((len(texts), len(self.net.languages)))
        cut, owner, held = [], [], []
        for i, text in enumerate(texts):
            for at in range(0, len(text), WINDOW * STEP):
                part = text[at : at + WINDOW * STEP]
                n = -(-len(part) // WINDOW)
                cut.append(part.ljust(n * WINDOW, b"\0"))
                owner += [i] * n
                held += [WINDOW] * (n - 1) + [len(part) - WINDOW * (n - 1)]
                if len(owner) >= STEP:
                    self._add(out, cut, owner, held)
                    cut, owner, held = [], [], []
        if owner:
            self._add(out, cut, owner, held)
        return out / out.sum(axis=1, keepdims=True)

    def _add(self, out: np.ndarray, cut: list[bytes], owner: list[int], held: list[int]) -> None:
        windows = np.frombuffer(b"".join(cut), np.uint8).reshape(-1, WINDOW)
        for at in range(0, len(windows), STEP):
            p = self.net.probabilities(self.pooled(windows[at : at + STEP])) * np.array(held[at : at + STEP])[:, None]
            np.add.at(out, owner[at : at + STEP], p)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], *, dims: int = 8, filters: int = 16, epochs: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 10) -> ByteConvNet:
    """Fit the network with Adam; the same input gives the same network."""
    rng = np.random.default_rng(seed)
    total = filters * len(WIDTHS)
    net = ByteConvNet(
        languages,
        rng.normal(0, 0.5, (256, dims)).astype(np.float32),
        [rng.normal(0, (w * dims) ** -0.5, (w, dims, filters)).astype(np.float32) for w in WIDTHS],
        np.zeros(total, np.float32),
        rng.normal(0, total**-0.5, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    params = [net.embed, *net.convs, net.bias, net.dense, net.offset]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    weight = 1 / np.maximum(1, np.bincount(labels, minlength=len(languages)))[labels]
    weight = weight / weight.mean()
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            x, y = windows[pick], labels[pick]
            pooled, places = net.pooled(x)
            p = net.probabilities(pooled)
            p[np.arange(len(y)), y] -= 1
            dz = (p * weight[pick][:, None] / len(y)).astype(np.float32)
            hidden = np.maximum(pooled + net.bias, 0)
            dh = (dz @ net.dense.T) * (hidden > 0)
            grads = [np.zeros_like(net.embed)]
            for k, (kernel, place) in enumerate(zip(net.convs, places, strict=True)):
                d = dh[:, k * filters : (k + 1) * filters]
                g = np.zeros_like(kernel)
                for j in range(len(kernel)):
                    chars = np.take_along_axis(x, place + j, 1)  # batch x filters
                    g[j] = np.einsum("bfd,bf->df", net.embed[chars], d)
                    np.add.at(grads[0], chars.ravel(), (d[:, :, None] * kernel[j].T[None]).reshape(-1, kernel.shape[1]))
                grads.append(g)
            grads += [dh.sum(0), hidden.T @ dz, dz.sum(0)]
            step += 1
            for p_, g, m, v in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p_ -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def fit(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", *, docs_per_language: int = 400, most_docs: int = 24_000, windows_per_doc: int = 3, key_col: str = "doc_id") -> ByteConvNet | None:
    """Train on windows of about docs_per_language texts of each language, chosen by a hash of the key.

    Every language that has a text is learned; where there are many, from fewer texts
    each, most_docs in all but 16 for each at least. So the driver receives about
    windows_per_doc windows of so many texts. Null or empty texts and null labels
    teach nothing; None if nothing is left. A repeated row teaches once.
    """
    marked = labelled.select(F.col(text_col).alias("text"), F.col(label_col).alias("label")).where("label is not null")
    counts = materialize(marked.groupBy("label").agg(F.count("*").alias("n")))
    each = min(docs_per_language, max(16, most_docs // max(1, counts.count())))
    rates = lean(counts.select("label", (F.lit(1.1 * each) / F.col("n")).alias("rate")))
    rows = labelled.select(F.col(text_col).alias("text"), F.col(label_col).alias("label"), F.col(key_col).cast("string").alias("key"))
    picked = rows.join(rates, "label").withColumn("h", F.xxhash64("key", F.lit(10))).where(unit(F.col("h")) < F.col("rate")).withColumn("t", F.xxhash64("text"))
    starts = [F.lit(1) + F.pmod(F.xxhash64("h", F.lit(k)), F.greatest(F.lit(1), F.length("text") - WINDOW // 2)) if k else F.lit(1) for k in range(windows_per_doc)]
    cut = picked.select("label", "h", "t", F.posexplode(F.array(*[F.substring("text", s.cast("int"), F.lit(WINDOW)) for s in starts])).alias("k", "piece"))
    sample = cut.where("piece <> ''").dropDuplicates(["label", "h", "t", "k"]).orderBy("h", "k", "label", "t").collect()
    if not sample:
        return None
    languages = sorted({r.label for r in sample})
    index = {lang: k for k, lang in enumerate(languages)}
    windows = np.frombuffer(b"".join(r.piece.encode()[:WINDOW].ljust(WINDOW, b"\0") for r in sample), np.uint8).reshape(-1, WINDOW)
    labels = np.array([index[r.label] for r in sample])
    return train(windows, labels, languages, epochs=max(6, min(40, 12000 // len(sample))))


def identify(docs: DataFrame, net: ByteConvNet | None, text_col: str = "text") -> Column:
    """struct(lang_pred, score) of each text; und with score 0 if it is null or has no letter, or nothing was learned."""
    shape = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    @F.pandas_udf(shape)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(net)
        for texts in batches:
            has = np.array([x is not None for x in texts], bool)
            lang = np.full(len(texts), UNDETERMINED, object)
            score = np.zeros(len(texts))
            if has.any():
                p = scorer.documents([x.encode() for x in texts[has]])
                lang[has] = np.array(net.languages, object)[p.argmax(axis=1)]
                score[has] = p.max(axis=1)
            yield pd.DataFrame({"lang_pred": lang, "score": np.minimum(score, 1.0)})

    unknown = F.struct(F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    if net is None:
        return unknown
    lettered = docs[text_col].rlike(r"\p{L}")
    found = predict(F.when(lettered, docs[text_col]))
    return F.struct(found["lang_pred"].alias("lang_pred"), found["score"].alias("score"))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", *, folds: int = 3, held_fold: int = 1, **fitting) -> DataFrame:
    """(id, held_out, lang_pred, score) for each row of docs.

    Learns only where crc32(id as text) mod folds is neither held_fold nor null. A
    null id is not held out, and teaches nothing. Equal texts get equal answers,
    whatever their ids; an empty table gives an empty result. Only the three named
    columns are read.
    """
    bucket = id_bucket(F.col(id_col), folds)
    net = fit(docs.where(bucket != held_fold), text_col, label_col, key_col=id_col, **fitting)
    rows = docs.select(id_col, text_col)
    out = rows.select(F.col(id_col), F.coalesce(bucket == held_fold, F.lit(False)).alias("held_out"), identify(rows, net, text_col).alias("_found"))
    return out.select(id_col, "held_out", "_found.lang_pred", "_found.score")


def least_score(languages: int, confidence: float) -> float:
    """The score that lies so far from chance, 1 / languages, to certainty."""
    return 1 / languages + confidence * (1 - 1 / languages) if languages else 1.0


def keep_identified(docs: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", *, confidence: float = 1 / 15, **fitting) -> DataFrame:
    """docs whose language is recognised; texts that are null or have no letter go.

    A text's best score is at least chance. It must be above chance by `confidence` of
    what lies between chance and certainty, so the rule is the same for any number of
    languages; texts between two languages or more stay, and what resembles none goes.
    """
    net = fit(docs.where(id_bucket(F.col(id_col), 3) != 1), text_col, label_col, key_col=id_col, **fitting)
    a, b = unused(docs, "a"), unused(docs, "b")
    hashes = {a: text_hash(F.col(text_col), 5), b: text_hash(F.col(text_col), 6)}
    texts = docs.select(F.col(text_col).alias("text"), *[v.alias(k) for k, v in hashes.items()])
    found = identify(texts, net, "text")
    least = least_score(len(net.languages) if net else 0, confidence)
    rejected = texts.select(a, b, found.alias("found")).where((F.col("found.lang_pred") == UNDETERMINED) | (F.col("found.score") < least)).select(a, b).distinct()
    return docs.withColumns(hashes).join(lean(rejected), [a, b], "left_anti").select(*docs.columns)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))
