"""A corpus from raw documents: toxic documents go, copies go, near copies go, test items go, and sources are mixed.

Each stage takes what its predecessor kept, read again from Parquet, and all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplume.llm import dart_minhash, decontaminate, exact_dedup, mixing, toxicity_crf
from gridplume.llm.common import located, table, without
from gridplume.session import as_written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents predicted toxic. The model learns from the documents it is given and their labels."""
    return toxicity_crf.keep_clean(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id stays."""
    docs, place = located(docs)
    return without(docs, place, exact_dedup.classes(docs).where(~F.col("kept")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least doc_id stays."""
    docs, place = located(docs)
    return without(docs, place, dart_minhash.classes(docs).where(~F.col("kept")))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of what is left: for each document the words that the mix takes from it."""
    return mixing.taken(mixing.mix(docs))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", decontamination),
    ("mixing", mixed),
]

#: Two stages learn a model or search by similarity, which SQL can't express; the tests hold the pipeline against brute
#: force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = as_written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
