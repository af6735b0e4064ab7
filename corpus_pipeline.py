"""A training-corpus pipeline of five operators.

Each stage is a function (spark, docs, sf_dir) -> DataFrame.  Its result is
written as parquet and read again as the next stage's documents.  All stages but
the last return the columns of documents; the last returns the packing.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedloom.llm import exact_dedup, mixing, packing, quality, simhash  # noqa: E402
from feedloom.llm.common import ship, spill  # noqa: E402
from feedloom.llm.tokens import default_tokenizer  # noqa: E402


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    ship(spark)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of identical texts."""
    ship(spark)
    return exact_dedup.drop_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    ship(spark)
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    ship(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every token in the training sequences."""
    ship(spark)
    return packing.pack_documents(docs, default_tokenizer())


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact),
    ("SimHash near-dedup", drop_near),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

#: SQL can't express the classifier; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = spill(docs, name.split()[0])
    return docs
