"""Corpus pipeline: toxicity, quality rules, near-duplicates, packing.

Each stage reads what its predecessor kept. Toxic documents go, then documents that the
quality rules reject, then all but one document of each near-duplicate group; the rest is
packed into training sequences. Near duplicates are texts whose sets of five-word shingles
are alike by 0.8 or more (see cairnspark/llm/nearcopies.py for why fingerprints do not serve).

Edge cases: a null text is an empty one: it is not toxic, fails the quality rules' least number of
words, and goes there; a null key is a document like others, and of a group it is kept only
where no other member has a key; rows with the same key and text stay or go together, rows with the same
key and different texts are judged apart; without labels of both kinds nothing counts as toxic; extra columns
are kept up to the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cairnspark.llm import packing, quality, simhash, toxicity
from cairnspark.llm.common import shared_folder, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_report(docs)


STAGES = [("toxicity", drop_toxic), ("quality_rules", keep_good), ("simhash", keep_one), ("packing", pack)]

#: SQL cannot express the string kernel, the expectation-maximisation or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read again."""
    docs, folder = table(spark, sf_dir, "documents"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
