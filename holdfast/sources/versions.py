"""Versioned tables: every write is a new folder, and one empty file publishes it.

    table/data/<part>/version=<run>/     what a run wrote for a part
    table/_published/<part>/<order>.<run>.<rows>

A part is one date partition (`day=2026-04-05`) or the whole table (`all`). A publication is an empty file
whose name says everything: it is there or it is not, in any store, without a rename or an overwrite. The
highest order counts, then the greater run id, so two writers of a part leave the later one's rows.
A run that ends anywhere before its publication has changed nothing that readers see, and a run that is
repeated under its id finds its publication and does nothing.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.sources.tables import _delete, _path

WHOLE = "all"
_RUN = re.compile(r"[A-Za-z0-9_-]+")
_NAME = re.compile(r"(\d{10})\.([A-Za-z0-9_-]+)\.(\d+)")


@dataclass(frozen=True, order=True)
class Publication:
    part: str
    order: int
    run: str
    rows: int

    @property
    def name(self) -> str:
        return f"{self.order:010d}.{self.run}.{self.rows}"

    def folder(self, table: str) -> str:
        return f"{table}/data/{self.part}/version={self.run}"


def _part(field: str | None, day: dt.date | None) -> str:
    return WHOLE if field is None else f"{field}={day.isoformat()}"


def day_of(part: str, field: str) -> dt.date | None:
    name, _, value = part.partition("=")
    return dt.date.fromisoformat(value) if name == field else None


def publications(spark: SparkSession, table: str, part: str = "*") -> list[Publication]:
    """All publications, in order; read from file names in one listing, no file is opened."""
    at, store = _path(spark, f"{table}/_published/{part}/*")
    found = []
    for entry in store.globStatus(at) or []:
        match = _NAME.fullmatch(entry.getPath().getName())
        if match:
            own = entry.getPath().getParent().getName()
            found.append(Publication(own, int(match[1]), match[2], int(match[3])))
    return sorted(found)


def current(spark: SparkSession, table: str, part: str = "*") -> dict[str, Publication]:
    """The publication that counts for each part."""
    return {p.part: p for p in publications(spark, table, part)}


def write_version(df: DataFrame, folder: str) -> int:
    """Write a folder that no reader knows yet; what an ended run left there goes first."""
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
    return written.get["rows"]


def publish(spark: SparkSession, table: str, publication: Publication) -> None:
    at, store = _path(spark, f"{table}/_published/{publication.part}/{publication.name}")
    store.create(at, False).close()


def _replace(df: DataFrame, table: str, part: str, run: str, fence: Callable[[], None] | None = None) -> int:
    if not _RUN.fullmatch(run):
        raise ValueError(f"A run id is of letters, digits, _ and -, not {run!r}.")
    spark = df.sparkSession
    earlier = publications(spark, table, part)
    done = [p.rows for p in earlier if p.run == run]
    if done:
        return done[-1]
    order = earlier[-1].order + 1 if earlier else 0
    rows = write_version(df, Publication(part, order, run, 0).folder(table))
    if fence is not None:
        fence()
    publish(spark, table, Publication(part, order, run, rows))
    return rows


def replace_table(df: DataFrame, table: str, run: str) -> int:
    """Replace all rows as run `run`; returns the rows written, also when the run was published before."""
    return _replace(df, table, WHOLE, run)


def replace_partition(
    df: DataFrame, table: str, field: str, day: dt.date, run: str, fence: Callable[[], None] | None = None
) -> int:
    """Replace one date partition as run `run`; the empty result is a version like any other.

    A row of another date, or without one, fails the write. `fence` is called last before the publication;
    what it raises keeps the version unpublished.
    """
    wrong = F.coalesce(F.col(f"`{field}`") != F.lit(day), F.lit(True))
    message = F.concat(F.lit("row of "), F.coalesce(F.col(f"`{field}`").cast("string"), F.lit("no date")), F.lit(f" in partition {day}"))
    checked = df.withColumn(field, F.when(wrong, F.raise_error(message).cast("date")).otherwise(F.col(f"`{field}`")))
    return _replace(checked, table, _part(field, day), run, fence)


def read(
    spark: SparkSession, table: str, schema: str | StructType, field: str | None = None, day: dt.date | None = None
) -> DataFrame:
    """Rows of the published versions: of the whole table, of all partitions, or of one day.

    Nothing published gives no rows.
    """
    part = _part(field, day) if field is None or day is not None else f"{field}=*"
    folders = [p.folder(table) for p in current(spark, table, part).values() if p.rows]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def latest(spark: SparkSession, table: str, field: str) -> dt.date | None:
    """The newest day whose published version has rows."""
    found = current(spark, table, f"{field}=*").values()
    return max((day_of(p.part, field) for p in found if p.rows), default=None)


def schema_of(spark: SparkSession, table: str) -> StructType:
    """Schema of a published version; tables keep one schema."""
    return spark.read.parquet(publications(spark, table)[-1].folder(table)).schema


def roll_back(spark: SparkSession, table: str, field: str | None, day: dt.date | None, run: str) -> None:
    """Publish an earlier version again, under a new order; its data must not have been vacuumed."""
    part = _part(field, day)
    known = publications(spark, table, part)
    back = [p for p in known if p.run == run]
    if not back:
        raise ValueError(f"Run {run} was never published for {part}.")
    publish(spark, table, Publication(part, known[-1].order + 1, run, back[-1].rows))


def bring_back(df: DataFrame, table: str, field: str, day: dt.date, run: str) -> None:
    """Make run `run` the one that counts for the day: publish it again if it was published, or else write `df` as it."""
    part = _part(field, day)
    spark = df.sparkSession
    known = publications(spark, table, part)
    if known and known[-1].run == run:
        return
    if any(p.run == run for p in known):
        roll_back(spark, table, field, day, run)
    else:
        replace_partition(df, table, field, day, run)


def vacuum(spark: SparkSession, table: str, keep: int = 1, older_than: dt.timedelta = dt.timedelta(days=7)) -> int:
    """Delete version folders that are not among the last `keep` publications of their part and were last
    changed before `older_than`, so neither readers nor running writers lose theirs. Returns how many."""
    kept: dict[str, list[str]] = {}
    for p in publications(spark, table):
        runs = [run for run in kept.get(p.part, []) if run != p.run]
        kept[p.part] = [*runs, p.run]
    at, store = _path(spark, f"{table}/data/*/version=*")
    limit = (dt.datetime.now() - older_than).timestamp() * 1000
    removed = 0
    for entry in store.globStatus(at) or []:
        part = entry.getPath().getParent().getName()
        run = entry.getPath().getName().removeprefix("version=")
        if run not in kept.get(part, [])[-keep:] and entry.getModificationTime() <= limit:
            _delete(spark, entry.getPath().toString())
            removed += 1
    return removed
