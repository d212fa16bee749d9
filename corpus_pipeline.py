"""Corpus pipeline: each stage works on all that the stage before it kept.

Quality drops what the classifier rejects, the n-gram join keeps one document of each class of near
copies, suffix-array dedup cuts out passages that still repeat, decontamination drops documents with
benchmark passages, and packing fills sequences with what is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import bwt, decontaminate, ngram_join, packing, quality
from gridloom.llm.common import stored


def _columns(made: DataFrame, docs: DataFrame) -> DataFrame:
    return made.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _columns(quality.score(docs, quality.fit(docs, labels)).where("predicted = 1"), docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.representatives(docs)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    made = bwt.cleaned(docs)
    if "n_chars" in docs.columns:
        made = made.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return made


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(docs))


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("repeats", repeats_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Classifier, token ids and packing are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
