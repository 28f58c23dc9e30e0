"""Table reads and writes: partitions, snapshots, run log, exports."""

from __future__ import annotations

import datetime as dt
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.schemas import RUN_LOG, RUN_LOG_FIELDS

_ABSENT = {
    "PATH_NOT_FOUND",
    "TABLE_OR_VIEW_NOT_FOUND",
    "UNABLE_TO_INFER_SCHEMA",
    "UNRESOLVED_COLUMN.WITH_SUGGESTION",
    "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION",
}


_scopes: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: `spark.checkpoint.dir`.

    Where the session names none, a local session uses a temporary folder; on a
    cluster that would be a different folder on each machine, so it is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if sc.getCheckpointDir() is None:
        if configured is None and not sc.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="holdfast-"))
    return configured or sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    folder = _scopes[-1] if _scopes else f"{shared_dir(spark)}/holdfast"
    return f"{folder}/{uuid.uuid4().hex}/{name}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """What is staged inside goes to one folder, which is deleted at the end.

    Results that are read later must be written elsewhere before it ends.
    """
    folder = f"{shared_dir(spark)}/holdfast/scope-{uuid.uuid4().hex}"
    _scopes.append(folder)
    try:
        yield folder
    finally:
        _scopes.remove(folder)
        _delete(spark, folder)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: list[str | None] = []
_freeing_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of each query that runs inside are deleted when it ends, not when the driver's
    garbage collector finds them. Meant for chains of staged tables: a plan that is executed twice
    would shuffle again.

    Scopes may overlap in threads; the last one to end restores the session's setting.
    """
    with _freeing_lock:
        _freeing.append(_freeing[0] if _freeing else spark.conf.get(_FREE_SHUFFLES, None))
        spark.conf.set(_FREE_SHUFFLES, True)
    try:
        yield
    finally:
        with _freeing_lock:
            before = _freeing.pop()
            if not _freeing and before is None:
                spark.conf.unset(_FREE_SHUFFLES)
            elif not _freeing:
                spark.conf.set(_FREE_SHUFFLES, before)


def _path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path of any store Spark reaches, and its file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _delete(spark: SparkSession, path: str) -> None:
    at, store = _path(spark, path)
    store.delete(at, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a result that several plans reuse, and read it back.

    Later plans then start from a table: they prune its columns, know its size,
    do not repeat the work before it, and survive lost executors.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, build: Callable[[], DataFrame], name: str = "settled") -> DataFrame:
    """Write what `build` returns, delete all that it staged on the way, and read the result back."""
    path = scratch_path(spark, name)
    with staging(spark):
        df = build()
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def run_query(spark: SparkSession, query: str, run_date: dt.date, **tables: DataFrame) -> DataFrame:
    """SQL with a `:run_date` parameter over named DataFrames (`{name}`)."""
    return spark.sql(query, args={"run_date": run_date}, **tables)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: str | StructType
) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def append_csv(
    spark: SparkSession, files: str | list[str], schema: str, table: str
) -> None:
    """Load CSV files with a fixed schema and append them to a table."""
    read_csv(spark, files, schema).write.mode("append").parquet(table)


def replace_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").parquet(table)


def replace_partition(df: DataFrame, table: str, field: str, day: dt.date) -> int:
    """Replace exactly one date partition and return the rows written.

    Dynamic overwrite swaps the partition in at commit, so a failing query keeps
    the old one. A row of another date fails the write. Dynamic overwrite leaves
    the old partition when nothing is written, so an empty result clears it.
    """
    message = F.format_string("row of %s in partition " + day.isoformat(), F.col(field))
    own_day = F.when(F.col(field) == F.lit(day), F.col(field)).otherwise(
        F.raise_error(message).cast("date")
    )
    written = Observation()
    (
        df.withColumn(field, own_day)
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(field)
        .parquet(table)
    )
    rows = written.get["rows"]
    if rows == 0:
        _delete(df.sparkSession, f"{table}/{field}={day.isoformat()}")
    return rows


def read_partition(spark: SparkSession, table: str, field: str, day: dt.date) -> DataFrame:
    return spark.read.parquet(table).where(F.col(field) == F.lit(day))


def latest_partition(spark: SparkSession, table: str, field: str) -> dt.date | None:
    """Newest loaded date; None when the table or the partitions do not exist.

    Read from the names of the partition folders: no data file is opened.
    """
    at, store = _path(spark, table)
    if not store.exists(at):
        return None
    names = [entry.getPath().getName() for entry in store.listStatus(at) if entry.isDirectory()]
    values = [name.removeprefix(f"{field}=") for name in names if name.startswith(f"{field}=")]
    days = [dt.date.fromisoformat(v) for v in values if v != "__HIVE_DEFAULT_PARTITION__"]
    return max(days, default=None)


def default_snapshot_path(folder: str, now: dt.datetime | None = None) -> str:
    return f"{folder}/snapshot_{(now or dt.datetime.now()):%Y%m%d_%H%M%S}.parquet"


def snapshot(
    spark: SparkSession, table: str, field: str | None, day: dt.date | None, path: str
) -> str:
    """Copy one partition, or the whole table, to Parquet or CSV by suffix."""
    df = read_partition(spark, table, field, day) if field else spark.read.parquet(table)
    return save_copy(df, path)


def save_copy(df: DataFrame, path: str) -> str:
    if path.endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_snapshot(
    spark: SparkSession, path: str, schema: str | StructType | None = None
) -> DataFrame:
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    if schema is not None:
        return read_csv(spark, path, schema)
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def append_run_record(spark: SparkSession, log: str, record: Mapping[str, Any]) -> None:
    """Append one run record; fields left out are written as missing."""
    row = {"execution_timestamp": dt.datetime.now().isoformat(), **record}
    row["sql_file"] = row["sql_file"].rsplit("/", 1)[-1]
    values = tuple(row.get(name) for name in RUN_LOG_FIELDS)
    spark.createDataFrame([values], RUN_LOG).coalesce(1).write.mode("append").json(log)


def load_history(spark: SparkSession, log: str) -> DataFrame:
    """All run records; empty when there has been no run."""
    try:
        return spark.read.schema(RUN_LOG).json(log)
    except AnalysisException as error:
        if error.getCondition() in _ABSENT:
            return spark.createDataFrame([], RUN_LOG)
        raise


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
