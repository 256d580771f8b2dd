"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read again."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from caselake.llm.decontamination import decontaminated
from caselake.llm.jaccard import one_of_each
from caselake.llm.mixing import mixed_documents
from caselake.llm.quality import good_documents
from caselake.llm.registry import table
from caselake.llm.surrogates import without_pii
from caselake.session import configure, scratch_path, scratch_tables


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities get surrogates; every document stays."""
    return without_pii(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixed_documents(docs)


def configured(stage):
    """The settings of the session hold for a stage that is called on its own, too."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", configured(quality)),
    ("near_duplicates", configured(near_duplicates)),
    ("decontamination", configured(decontaminate)),
    ("pii", configured(pii)),
    ("mixing", configured(mix)),
]

# fitted trees, similarity groups and suffix automata have no SQL; the tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's intermediate tables go when its result is written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_tables(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
