"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardmill.llm import exact_dedup, mixing, ngram_join, ordinal_quality, packing
from wardmill.llm.common import read_documents, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for low quality or toxic go."""
    model = ordinal_quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ordinal_quality.selected(docs, model)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by near-duplicate links the one with the smallest id stays."""
    return ngram_join.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the sources' targets take: documents repeat, stay, or are cut or left out where a target is reached."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed sequences of what is left."""
    return packing.piece_digests(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("n-gram join", near_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
#: A trained model, exact set joins and token ids are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name.replace(' ', '-')}")
    return docs
