"""A corpus from documents: grade, drop near duplicates and leaked test items, mix sources, put into shards.

Each stage takes the rows that the stage before it kept, as a table, and all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siltworks.llm.decontaminate import drop_leaks
from siltworks.llm.mixing import mix_documents
from siltworks.llm.ngram_join import drop_near_duplicates
from siltworks.llm.quality import keep_good, rated, train
from siltworks.llm.sharding import shard_documents
from siltworks.llm.tables import written

SHARDS = 16


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    return keep_good(docs, train(docs, rated(spark.read.parquet(f"{sf_dir}/labels.parquet"))))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that links of similar texts connect."""
    return drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their number in it."""
    return shard_documents(docs, SHARDS)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

# A fitted classifier and random draws are not SQL: tests/llm/test_pipeline.py has the plain version of each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
