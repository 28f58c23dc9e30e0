"""Files loaded exactly once, malformed rows set aside (S3).

    table/data/load=<id>/bad=<true|false>/   rows of one load
    table/ledger/load=<id>/                  the files it read: path, length, change time
    table/_loads/<id>                        an empty file: the load counts

A load takes the files that no load that counts has read; a file that was changed is a new one. Its id is made
of those files, so a load that ended anywhere before its last step is done over in the same folders.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from holdfast.sources.tables import _path

LEDGER = "path string, length long, changed timestamp"
RAW, FILE, BAD = "_raw", "_file", "bad"


@dataclass(frozen=True)
class Report:
    load: str | None
    files: int
    good: int
    quarantined: int


def _schema(schema: str | StructType) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def published(spark: SparkSession, table: str) -> list[str]:
    """Ids of the loads that count, from file names."""
    at, store = _path(spark, f"{table}/_loads/*")
    names = [entry.getPath().getName() for entry in store.globStatus(at) or []]
    return sorted(name for name in names if re.fullmatch(r"[0-9a-f]{32}", name))


def _of_loads(spark: SparkSession, table: str, kind: str, schema: StructType) -> DataFrame:
    folders = [f"{table}/{kind}/load={load}" for load in published(spark, table)]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def ledger(spark: SparkSession, table: str) -> DataFrame:
    return _of_loads(spark, table, "ledger", _schema(LEDGER))


def new_files(spark: SparkSession, source: str | list[str], table: str) -> DataFrame:
    """LEDGER rows of files under `source` that no load has read as they are now. Lists, reads no content."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    files = listed.select("path", "length", F.col("modificationTime").alias("changed"))
    return files.join(ledger(spark, table), ["path", "length", "changed"], "left_anti")


def _stored(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(RAW, StringType()), StructField(FILE, StringType())])


def write_rows(spark: SparkSession, paths: list[str], schema: StructType, folder: str) -> tuple[int, int]:
    """One scan of the files: rows as declared, and what does not fit them as its raw line."""
    parsed = (
        spark.read.schema(StructType([*schema.fields, StructField(RAW, StringType())]))
        .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=RAW)
        .csv(paths)
    )
    bad = F.col(RAW).isNotNull()
    counts = Observation()
    (
        parsed.select("*", F.col("_metadata.file_path").alias(FILE), bad.alias(BAD))
        .observe(counts, F.count_if(~F.col(BAD)).alias("good"), F.count_if(F.col(BAD)).alias("bad"))
        .write.mode("overwrite")
        .partitionBy(BAD)
        .parquet(folder)
    )
    return counts.get["good"], counts.get["bad"]


def write_ledger(files: DataFrame, folder: str) -> None:
    files.coalesce(1).write.mode("overwrite").parquet(folder)


def publish(spark: SparkSession, table: str, load: str) -> None:
    at, store = _path(spark, f"{table}/_loads/{load}")
    store.create(at, True).close()


def load_files(spark: SparkSession, source: str | list[str], schema: str | StructType, table: str) -> Report:
    """Append CSV files with a header to a table, each once, however often this is called.

    Lines that do not parse as declared (a cell of another type, too many or too few cells) go to the
    quarantine with their text and file; they never become rows with missing cells. Names of new files pass
    through the driver, as for any scan. Let one loader at a time work on a table.
    """
    fields = _schema(schema)
    files = new_files(spark, source, table).collect()
    if not files:
        return Report(None, 0, 0, 0)
    found = spark.createDataFrame(files, _schema(LEDGER))
    named = F.concat_ws("|", "path", "length", F.col("changed").cast("double"))
    load = found.agg(F.md5(F.array_join(F.array_sort(F.collect_list(named)), "\n"))).first()[0]
    good, bad = write_rows(spark, [f["path"] for f in files], fields, f"{table}/data/load={load}")
    write_ledger(found, f"{table}/ledger/load={load}")
    publish(spark, table, load)
    return Report(load, len(files), good, bad)


def _rows(spark: SparkSession, table: str, schema: str | StructType, bad: bool) -> DataFrame:
    stored = StructType([*_stored(_schema(schema)).fields, StructField(BAD, BooleanType())])
    folders = [f"{table}/data/load={load}" for load in published(spark, table)]
    if not folders:
        return spark.createDataFrame([], stored)
    rows = spark.read.schema(stored).option("basePath", f"{table}/data").parquet(*folders)
    return rows.where(F.col(BAD) == F.lit(bad))


def read(spark: SparkSession, table: str, schema: str | StructType) -> DataFrame:
    """Rows of all loads that count."""
    return _rows(spark, table, schema, False).select(*[f"`{f.name}`" for f in _schema(schema)])


def quarantine(spark: SparkSession, table: str, schema: str | StructType) -> DataFrame:
    """(line, file) of what was set aside."""
    return _rows(spark, table, schema, True).select(F.col(RAW).alias("line"), F.col(FILE).alias("file"))
