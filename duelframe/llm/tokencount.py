"""Token counts without token ids.

A text's tokens are those of its pre-tokens, and pre-tokens repeat. So the pieces of
each distinct pre-token are counted once, and joined to the documents' pre-token
frequencies. The most frequent pre-tokens, a bounded number, are looked up where
the documents are read; only the rest is shuffled.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cached_property

import pandas as pd
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from tokenizers import Regex, Tokenizer
from tokenizers.normalizers import Normalizer
from tokenizers.pre_tokenizers import PreTokenizer, Split

from duelframe.llm.common import materialize, table

#: Pre-tokens that every task gets with their counts; about 4 MB.
FREQUENT = 1 << 17
#: Rows or distinct words that a task holds before it hands them on.
HELD = 50_000
#: Texts of a batch that are Python strings at a time.
TEXTS = 500
MOST_TOKENS = 2048
#: From here on characters may be of a later Unicode than Python's; words that have any are left to the library.
_LATER = "\u0530"
_CONTROL, _SPACE = "\x1c\x1d\x1e\x1f", regex.compile(r"\p{White_Space}+")


_NFC_LOWER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


class PreTokens:
    """A tokenizer file's way from a text to pre-tokens; loaded again in each Python process.

    Serves files whose pre-tokenizer is one Split by a pattern that keeps the
    matches and matches no white space, alone or followed by a ByteLevel that
    doesn't split, and whose normalizer is the sequence NFC, white space, lower case.
    So a text's pre-tokens are those of its words, and words repeat as well.
    """

    def __init__(self, path: str):
        self.path = path

    def __getstate__(self) -> dict:
        return {"path": self.path}

    @cached_property
    def _said(self) -> dict:
        with open(self.path, encoding="utf-8") as f:
            return json.load(f)

    @cached_property
    def tokenizer(self) -> Tokenizer:
        """Of pre-tokens: these are normalised and split, and doing so again could change them, as lower case can undo NFC."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; more threads would each hold memory
        steps = self._said["pre_tokenizer"]
        rest = steps.get("pretokenizers", [steps])[1:]
        return Tokenizer.from_str(json.dumps(self._said | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": rest} if rest else None}))

    @cached_property
    def _normalizer(self) -> Normalizer:
        return Tokenizer.from_file(self.path).normalizer

    @cached_property
    def _split(self) -> PreTokenizer:
        steps = self._said["pre_tokenizer"]
        split = steps.get("pretokenizers", [steps])[0]
        return Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), split["invert"])

    @cached_property
    def _parts(self) -> tuple:
        said = self._said
        steps = said["pre_tokenizer"]
        steps = steps.get("pretokenizers", [steps])
        split, rest = steps[0], steps[1:]
        if split["type"] != "Split" or (split["behavior"], split["invert"]) != ("Removed", True) or any(x["type"] != "ByteLevel" or x["use_regex"] or x["add_prefix_space"] for x in rest):
            raise ValueError(f"{self.path}: only a Split that keeps its matches is known")
        if (said["normalizer"] or {}).get("normalizers") != _NFC_LOWER:
            raise ValueError(f"{self.path}: only the normalizer NFC, white space, lower case is known")
        added = said["added_tokens"]
        if any(x["normalized"] or x["single_word"] or x["lstrip"] or x["rstrip"] or not x["content"].isprintable() or " " in x["content"] for x in added):
            raise ValueError(f"{self.path}: only added tokens that match as they are written are known")
        pattern = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        special = regex.compile("|".join(regex.escape(x["content"]) for x in added)) if added else None
        return pattern.findall, special

    def words(self, text: str | None) -> list[str]:
        """A text's words; str.split parts at four control characters too, which are no white space to the tokenizer."""
        if not text:
            return []
        return [w for w in _SPACE.split(text) if w] if any(c in text for c in _CONTROL) else text.split()

    def of_word(self, word: str) -> tuple[list[str], int]:
        """(pre-tokens, special tokens written out) of a word."""
        find, special = self._parts
        if word.isascii() and "<" not in word:
            return find(word.lower()), 0
        parts = special.split(word) if special else [word]
        if max(word) >= _LATER:
            return [t for x in parts for t, _ in self._split.pre_tokenize_str(self._normalizer.normalize_str(x))], len(parts) - 1
        # lower case goes character by character: a final sigma is a sigma like others
        return [t for x in parts for t in find(unicodedata.normalize("NFC", x).replace("\u03a3", "\u03c3").lower())], len(parts) - 1

    def frequencies(self, text: str | None) -> tuple[Counter, int]:
        """(count of each pre-token, special tokens written out in the text)."""
        counts, own = Counter(), 0
        for word, n in Counter(self.words(text)).items():
            found, special = self.of_word(word)
            own += n * special
            for t in found:
                counts[t] += n
        return counts, own

    def pieces(self, pre_tokens: list[str]) -> list[int]:
        encode = self.tokenizer.encode_batch_fast
        return [len(x) for k in range(0, len(pre_tokens), TEXTS) for x in encode(pre_tokens[k : k + TEXTS], add_special_tokens=False)]


def vocabulary(docs: DataFrame, tokens: PreTokens, text_col: str = "text") -> DataFrame:
    """(token, n, pieces): every distinct pre-token, its frequency in all texts and its count of pieces."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            counts: Counter = Counter()
            for word, n in held.items():
                for t in tokens.of_word(word)[0]:
                    counts[t] += n
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["token", "n"])

        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                for text in batch.column(0).slice(k, TEXTS).to_pylist():
                    held.update(tokens.words(text))
                    if len(held) >= HELD:
                        yield out()
        yield out()

    @F.pandas_udf(IntegerType())
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(tokens.pieces(batch.tolist()), dtype="int32")

    counts = docs.select(text_col).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return counts.select("token", "n", pieces("token").alias("pieces"))


def _most_frequent(known: DataFrame, most: int) -> dict[str, int]:
    """pieces of the most frequent pre-tokens, most at most: those from the least frequency on that so many have.

    The driver receives a histogram of at most 512 bars, and then these rows alone.
    """
    bar = F.floor(F.log2("n") * 8).cast("int")
    bars = known.groupBy(bar.alias("bar")).agg(F.count("*").alias("n")).collect()
    least, total = None, 0
    for r in sorted(bars, key=lambda r: -r.bar):
        total += r.n
        if total > most:
            break
        least = r.bar
    return {} if least is None else {r.token: r.pieces for r in known.where(bar >= least).select("token", "pieces").collect()}


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, most_tokens: int = MOST_TOKENS, frequent: int = FREQUENT) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) for each row of docs.

    The count is that of the tokenizer in path, without added tokens; special
    strings inside a text count as the one token they are. A null text is an empty
    one, and has no tokens. Rows are told apart by id and two 64-bit hashes of the
    text; equal rows are counted together and come back as often as they are, null
    ids included. An empty table gives an empty result; other columns aren't read.
    """
    tokens = PreTokens(path)
    known = materialize(vocabulary(docs, tokens, text_col))
    held = docs.sparkSession.sparkContext.broadcast(_most_frequent(known, frequent))

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text, F.lit(1)).alias("a"), F.xxhash64(text, F.lit(2)).alias("b"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = held.value.get
        names = ["id", "a", "b", "n_bytes", "docs", "token", "n"]

        def out(batch: pa.RecordBatch, at: list[int], is_doc: list[int], token: list[str], n: list[int]) -> pa.RecordBatch:
            picked = batch.select(["id", "a", "b", "n_bytes"]).take(pa.array(at, pa.int64()))
            return pa.RecordBatch.from_arrays([*picked.columns, pa.array(is_doc, pa.int64()), pa.array(token, pa.string()), pa.array(n, pa.int64())], names)

        seen: dict[str, int] = {}  # pieces of words that have only frequent pre-tokens and special tokens
        for batch in (whole.slice(k, TEXTS) for whole in batches for k in range(0, whole.num_rows, TEXTS)):
            at, is_doc, token, n = [], [], [], []
            for k, (x, key) in enumerate(zip(batch.column("text").to_pylist(), batch.column("a").to_pylist(), strict=True)):
                own, rare = 0, {}
                for word, c in Counter(tokens.words(x)).items():
                    pieces = seen.get(word)
                    if pieces is None:
                        found, pieces = tokens.of_word(word)
                        others = False
                        for t in found:
                            p = get(t)
                            if p is None:
                                others = True
                                rare[t] = rare.get(t, 0) + c
                            else:
                                pieces += p
                        if not others:
                            seen[word] = pieces
                    own += pieces * c
                at += [k] * (len(rare) + 1)
                is_doc += [0] * len(rare) + [1]
                token += [*rare, f" {key}"]  # no pre-token has a space, and keys spread over the tasks
                n += [*rare.values(), own]
                if len(at) >= HELD:
                    yield out(batch, at, is_doc, token, n)
                    at, is_doc, token, n = [], [], [], []
                if len(seen) > HELD:
                    seen.clear()
            if at:
                yield out(batch, at, is_doc, token, n)

    parts = rows.mapInArrow(split, f"id {kind}, a long, b long, n_bytes long, docs long, token string, n long")
    joined = parts.join(known.select("token", "pieces"), "token", "left").withColumn("n", F.col("n") * F.coalesce("pieces", F.lit(1)))
    total = joined.groupBy("id", "a", "b").agg(F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    one = total.select("id", "n_bytes", F.expr("n div docs").alias("n_tokens"), F.explode(F.sequence(F.lit(1), F.col("docs"))).alias("copy"))
    return one.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > most_tokens).alias("over_limit"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
