"""Exact distinct accounts that add up: dense account numbers and bitmaps per group.

A distinct count of one day says nothing about two days, since accounts stand in both. A bitmap of account
numbers does: bitmaps of days, partitions or overlapping populations are merged by OR and counted, without
another pass over the rows. Numbers are dense and kept between runs, so bitmaps are full (4 KB for 32,768
accounts) and those of earlier runs stay right.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.operators.population import ACCOUNT, FUNNEL, funnel_rows, members
from holdfast.sources.tables import stage

#: New accounts that are numbered in one sort.
ACCOUNTS_PER_PART = 1 << 20


def account_numbers(spark: SparkSession, path: str, before: int | None = None, kind: str = "string") -> DataFrame:
    """billing_account and number (from 1, dense) of all runs, or of those before a run."""
    spark.createDataFrame([], f"{ACCOUNT} {kind}, number long").write.mode("ignore").parquet(f"{path}/run=0")
    found = spark.read.schema(f"{ACCOUNT} {kind}, number long, run int").parquet(path)
    return (found if before is None else found.where(F.col("run") < before)).select(ACCOUNT, "number")


def register_accounts(rows: DataFrame, path: str, run: int) -> DataFrame:
    """Number the accounts of `rows` that no earlier run has; returns the numbers of all runs up to this one.

    Runs count from 1 and go up. A run done again replaces what it wrote and gives the same numbers for the same rows,
    as long as no later run has been made (an error). Rows without an account are left out.
    """
    spark, kind = rows.sparkSession, rows.schema[ACCOUNT].dataType.simpleString()
    known = account_numbers(spark, path, run, kind)
    later = spark.read.schema(f"run int, {ACCOUNT} {kind}").parquet(path).where(F.col("run") > run)
    if run < 1 or not later.isEmpty():
        raise ValueError(f"run {run} is not the last")
    accounts = rows.select(ACCOUNT).where(F.col(ACCOUNT).isNotNull()).distinct()
    fresh = stage(accounts.join(known, ACCOUNT, "left_anti"), "fresh_accounts")
    start = known.agg(F.max("number")).first()[0] or 0
    parts = fresh.count() // ACCOUNTS_PER_PART + 1
    dealt = fresh.withColumn("part", F.pmod(F.xxhash64(ACCOUNT), F.lit(parts)))
    # One row per part of a million accounts.
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    offsets = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(ACCOUNT))
    numbered = dealt.withColumn("place", place).join(F.broadcast(offsets), "part")
    number = (F.lit(start) + F.col("offset") + F.col("place")).cast("long")
    numbered.select(ACCOUNT, number.alias("number")).write.mode("overwrite").parquet(f"{path}/run={run}")
    return account_numbers(spark, path, run + 1, kind)


def account_bitmaps(rows: DataFrame, numbers: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns `by`, bucket and bits: which accounts each group has.

    Bits are set before the shuffle, which takes one bitmap per group and bucket from each task, however many rows a
    group has. An account without a number is an error; rows without an account count nowhere; NULL is a group.
    """
    known = rows.where(F.col(ACCOUNT).isNotNull()).select(ACCOUNT, *by).join(
        numbers.select(ACCOUNT, F.col("number").alias("account_number")), ACCOUNT, "left"
    )
    missing = F.raise_error(F.lit("an account has no number: register it first")).cast("long")
    number = F.coalesce(F.col("account_number"), missing)
    return (
        known.withColumn("account_number", number)
        .groupBy(*by, F.bitmap_bucket_number("account_number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("account_number")).alias("bits"))
    )


def merge_bitmaps(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Bitmaps of coarser groups, or of several tables put together by unionByName."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_accounts(bitmaps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Columns `by` and accounts, from bitmaps of these or of finer groups."""
    merged = merge_bitmaps(bitmaps, by)
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("long").alias("accounts"))


def funnel_bitmaps(labelled: DataFrame, numbers: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Bitmaps of the funnel's populations (they overlap), for each group of `by`, such as days."""
    titles = F.array_compact(F.array(*[F.when(members(name), F.lit(title)) for title, name in FUNNEL]))
    spread = labelled.select(ACCOUNT, *by, F.explode(titles).alias("population"))
    return account_bitmaps(spread, numbers, [*by, "population"])


def funnel_of_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """The funnel of all that the bitmaps hold; equal to `population.funnel` of their rows."""
    accounts = distinct_accounts(bitmaps, ["population"])
    totals = accounts.agg(
        *[F.coalesce(F.sum(F.when(F.col("population") == title, F.col("accounts"))), F.lit(0)).alias(name) for title, name in FUNNEL]
    )
    return funnel_rows(totals)
