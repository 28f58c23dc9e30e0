"""Quality of a growing table from measures kept per partition (Q1-Q4, Q6).

A versioned table partitioned by date (`sources/versions.py`) gets two small versioned tables beside it:

    state/measures   a row per partition: rows, and missing values per column
    state/keys       a row per partition and key: rows

Each partition of the state is published under the run of the data that it measures. `refresh` measures just the
partitions whose published run is another one (new, replaced or rolled back), and the merged results equal
those of `operators/quality.py` over the whole table. A refresh that is ended anywhere is done over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from holdfast.operators.quality import is_missing
from holdfast.sources import versions


def _measures_schema(field: str) -> str:
    return f"`{field}` date, measured_rows long, missing map<string,long>"


def _keys_schema(schema: StructType, field: str, keys: Sequence[str]) -> StructType:
    own = [schema[k] for k in keys if k != field]
    return StructType([StructField(field, DateType()), *own, StructField("key_rows", LongType())])


def partition_measures(df: DataFrame, field: str) -> DataFrame:
    """One row without a date: rows, and missing values per column; an empty partition has 0 of both."""
    entries = [e for c, kind in df.dtypes for e in (F.lit(c), F.count_if(is_missing(c, kind)))]
    return df.agg(F.count(F.lit(1)).alias("measured_rows"), F.create_map(*entries).alias("missing"))


def refresh(spark: SparkSession, table: str, schema: StructType, field: str, state: str, keys: Sequence[str]) -> list[str]:
    """Measure the partitions that changed since the last refresh; returns their names in order.

    Each is read twice, one scan for its measures and one for the key columns alone.
    """
    have = {kind: versions.current(spark, f"{state}/{kind}", f"{field}=*") for kind in ("keys", "measures")}
    changed = []
    for part, now in versions.current(spark, table, f"{field}=*").items():
        stale = [kind for kind, known in have.items() if part not in known or known[part].run != now.run]
        if not stale:
            continue
        day = versions.day_of(part, field)
        df = versions.read(spark, table, schema, field, day)
        for kind in stale:
            if kind == "measures":
                own = partition_measures(df, field)
            else:
                own = df.groupBy(*[f"`{k}`" for k in keys if k != field]).agg(F.count(F.lit(1)).alias("key_rows")).where("key_rows > 0")
            versions.bring_back(own.withColumn(field, F.lit(day)), f"{state}/{kind}", field, day, now.run)
        changed.append(part)
    return changed


def merged_measures(spark: SparkSession, schema: StructType, field: str, state: str) -> DataFrame:
    """`quality.table_measures` of the whole table."""
    rows = versions.read(spark, f"{state}/measures", _measures_schema(field), field)
    missing = F.aggregate(F.map_values("missing"), F.lit(0).cast("long"), lambda a, b: a + b)
    share = F.sum(missing) * 100.0 / F.nullif(F.sum("measured_rows") * len(schema), F.lit(0))
    return rows.agg(
        F.coalesce(F.sum("measured_rows"), F.lit(0)).alias("row_count"),
        F.coalesce(share, F.lit(0.0)).alias("null_percentage"),
    )


def missing_by_column(spark: SparkSession, field: str, state: str) -> DataFrame:
    """Missing values and rows per column of the whole table."""
    rows = versions.read(spark, f"{state}/measures", _measures_schema(field), field)
    entries = rows.select("measured_rows", F.explode("missing").alias("column", "missing"))
    return entries.groupBy("column").agg(F.sum("missing").alias("missing"), F.sum("measured_rows").alias("rows"))


def merged_violations(spark: SparkSession, schema: StructType, field: str, state: str, keys: Sequence[str]) -> DataFrame:
    """`quality.key_violations` of the whole table, for one key column or several: a key of two partitions counts."""
    rows = versions.read(spark, f"{state}/keys", _keys_schema(schema, field, keys), field)
    counted = rows.groupBy(*[f"`{k}`" for k in keys]).agg(F.sum("key_rows").alias("rows"))
    unset = F.lit(False)
    for k in keys:
        unset = unset | F.col(f"`{k}`").isNull()
    return counted.where(unset | (F.col("rows") > 1))
