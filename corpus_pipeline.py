"""Corpus pipeline: each stage is written as Parquet and read again by the next.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm import packing, toxicity as tox
from fraudlake.llm.common import read, store
from fraudlake.llm.decontam import drop_contaminated
from fraudlake.llm.line_templates import drop_boilerplate
from fraudlake.llm.minhash_dedup import drop_near_duplicates


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model rejects go."""
    model = tox.train(docs, read(spark, sf_dir, "labels"))
    return tox.score(docs, model, into="__tox").filter(~F.col("__tox.rejected")).drop("__tox")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go; every document stays."""
    return drop_boilerplate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents packed into sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("packing", packed)]

#: SQL can express neither the fitted model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
