"""From raw documents to token records: quality, near copies, benchmark leaks, mix, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.decontaminate import find_leaks
from holdfast.llm.jaccard_join import keep_one
from holdfast.llm.mixing import Target, mixed_documents
from holdfast.llm.quality import score_quality
from holdfast.llm.records import token_records
from holdfast.sources.tables import stage

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(docs, labels).where("predicted = 1").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group tied by Jaccard similarities of 0.8 over five-word shingles."""
    return keep_one(docs, width=5, num=80, den=100)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item."""
    found = find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~F.col("contaminated")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, those of small sources again until the target mix is met."""
    return mixed_documents(docs, Target())


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token records, and where each document's lie."""
    from public_tokenizers import path

    return token_records(docs, path("byte_bpe_50k.json"), end_id=2)


STAGES = [
    ("quality classifier", drop_low_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("source mixing", mix),
    ("token records", write_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
