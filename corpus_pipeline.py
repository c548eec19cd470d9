"""The document pipeline: five stages, each over all that its predecessor kept.

Every stage but the last returns the columns of documents. ``run`` writes each stage's result as Parquet in the shared
scratch folder and reads it again, so a lost executor costs one stage's tasks and not the whole chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanewright.llm import mixing, packing, similar_texts, suffix_dedup, toxicity
from lanewright.llm.queries import tokenizer_path
from lanewright.scratch import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return similar_texts.drop_similar(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("suffix_array", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Fingerprints, fitted models and tokenizers are beyond SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
