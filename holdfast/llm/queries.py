"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.jaccard_join import link_documents

    found = link_documents(_documents(spark, sf_dir), width=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.mixing import Target, mix_sources

    return mix_sources(_documents(spark, sf_dir), Target())


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.decontaminate import RESULTS, find_leaks

    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_leaks(_documents(spark, sf_dir).select("doc_id", "text"), benchmark).select("doc_id", *RESULTS)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.quality import RESULTS, score_quality

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(_documents(spark, sf_dir).select("doc_id", "text"), labels).select("doc_id", *RESULTS)


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from holdfast.llm.records import token_records

    return token_records(_documents(spark, sf_dir), path("byte_bpe_50k.json"), end_id=2)


def op9_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.warc import archive_pages

    return archive_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op3_rp_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.rp_forest import nearest_neighbours

    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.line_dedup import line_decisions

    found = line_decisions(_documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", F.array_join(F.col("dropped"), ",").alias("dropped"))


def op8_token_count_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    from holdfast.llm.token_counts import WORDS_1, WORDS_2, Tokenizer, corpus_totals
    from holdfast.sources.tables import scratch_path

    bpe = Tokenizer("byte_bpe_50k@1", path("byte_bpe_50k.json"))
    return corpus_totals(_documents(spark, sf_dir), scratch_path(spark, "ledger"), bpe, WORDS_1, WORDS_2)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.secrets import RESULTS, find_secrets

    return find_secrets(_documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", *RESULTS)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.whitening import whiten

    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=16)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.spelling import spelling_variants

    return spelling_variants(_documents(spark, sf_dir)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_virtual_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from holdfast.llm.shards import shard_documents

    return shard_documents(_documents(spark, sf_dir), shards=16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """By operator number."""
    own = [f for name, f in globals().items() if name.startswith("op")]
    return {f.__name__: f for f in sorted(own, key=lambda f: int(f.__name__[2:].split("_")[0]))}


def oracle_sql() -> dict[str, str]:
    """SQL where it can express the operator; the others are tested against brute force."""
    from holdfast.llm import oracle

    return {
        "op1_ngram_jaccard_join": oracle.OP1,
        "op4_benchmark_decontamination": oracle.OP4,
        "op9_warc_archives": oracle.OP9,
    }
