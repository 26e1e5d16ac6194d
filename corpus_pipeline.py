"""A training corpus from documents: toxic ones go, one of each group of near copies stays, benchmark leaks go, secrets are masked, the rest is encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import bpe, decontaminate, jaccard, secrets, toxicity
from sparkloom.llm.shared import saved


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.kept(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies share four fifths of their shingles of five words."""
    return jaccard.one_of_each(docs, width=5, percent=80)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.kept(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    forest = secrets.fit(secrets.labelled_findings(spark))
    return secrets.redacted(docs, forest, "source" if "source" in docs.columns else None)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ids = bpe.encode(docs)
    return ids.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("encoding", encoded),
]

#: No SQL states the classifiers and the latent search; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written as a table and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
