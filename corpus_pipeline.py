"""The training-data pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearshelf.llm import decontaminate, mixing, sharding, simhash, toxicity
from clearshelf.sources.tables import stage


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies."""
    return simhash.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their size, shard and slot."""
    placed = sharding.shard_documents(docs)
    columns = [F.col(f"row.`{c}`").alias(c) for c in ("doc_id", "text", "lang", "source", "n_chars")]
    return placed.select(*columns, "size", "text_crc32", "shard", "slot")


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", source_mix),
    ("sharding", shards),
]

#: Three stages run models, an automaton and components that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name)
    return docs
