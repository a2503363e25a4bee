"""A corpus pipeline: every stage takes what the one before it kept.

A stage is (name, function) and the function takes (spark, docs, sf_dir). All but
the last return the columns of documents; the last adds the mix to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duelframe.llm import decontam, langid, mixing, simhash, toxicity
from duelframe.llm.common import discard, materialize, scratch, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language that the network recognises stay."""
    return langid.keep_identified(docs)


def toxic_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without toxic passages stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that cover no benchmark item stay."""
    return decontam.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with the words taken and the number of their pieces."""
    mixed = mixing.mix(docs)
    return mixed.where("taken > 0").selectExpr("doc_id", "source", "size", "source_size", "target", "taken", "size(pieces) as pieces")


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxic_passages),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

#: Trained models and hashes take part in every stage, so no SQL stands for the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's result is a table in the shared folder until the next one's is; what a stage writes besides goes with it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        with scratch(spark) as made:
            now = materialize(stage(spark, docs, sf_dir))
            made.remove(now.folder)
        discard(before)
        docs = before = now
    return STAGES[-1][1](spark, docs, sf_dir)
