"""Incremental loading of a date-partitioned table.

The loop over dates runs on the driver, as any scheduler would; the work of each
date is one Spark plan. Dates of a versioned target can run side by side.
"""

from __future__ import annotations

import datetime as dt
import queue
import threading
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.dates import missing_dates, target_date
from holdfast.operators import quality
from holdfast.sources import tables, versions

Query = Callable[[SparkSession, dt.date], DataFrame]

STATUS_SCHEMA = "run_date date, ok boolean, rows bigint, snapshot string, error string"


class TimedOut(RuntimeError):
    """The date was given up; what it still does must not be published."""


class DataNotReady(RuntimeError):
    """The upstream table has no rows for the date yet."""


@dataclass(frozen=True)
class Target:
    """Where a query's result goes and how its runs are recorded."""

    table: str
    script: str
    log: str
    partition_field: str | None = None
    snapshot_folder: str | None = None
    snapshot_suffix: str = "parquet"
    #: Write partitions as published versions (`holdfast.sources.versions`).
    versioned: bool = False


def available(upstream: DataFrame, day: dt.date, field: str = "inference_date") -> DataFrame:
    """One row telling whether the upstream has at least one row for the date."""
    return upstream.where(F.col(field) == F.lit(day)).limit(1).agg(
        (F.count(F.lit(1)) > 0).alias("available")
    )


def require_available(
    upstream: DataFrame | None, day: dt.date, field: str = "inference_date"
) -> None:
    """Raise unless the upstream is ready; no upstream means no check."""
    if upstream is not None and upstream.where(F.col(field) == F.lit(day)).isEmpty():
        raise DataNotReady(f"No upstream rows for {day.isoformat()} yet.")


def dates_to_run(
    spark: SparkSession,
    run_date: dt.date | str,
    mode: str,
    target: Target,
    catch_up: bool = False,
) -> tuple[list[dt.date], str | None]:
    """Dates to process, and why a catch-up fell back to the target date alone."""
    end = target_date(run_date, mode)
    if not catch_up:
        return [end], None
    if target.partition_field is None:
        return [end], "the target is not partitioned"
    source = versions.latest if target.versioned else tables.latest_partition
    latest = source(spark, target.table, target.partition_field)
    if latest is None:
        return [end], "the target has no loaded partition to start from"
    missing = missing_dates(latest, end, mode)
    return (missing, None) if missing else ([end], "no date is missing")


def extract(
    spark: SparkSession,
    query: Query,
    day: dt.date,
    target: Target,
    upstream: DataFrame | None = None,
    run_id: str | None = None,
    fence: Callable[[], None] | None = None,
) -> tuple[str | None, int | None]:
    """Guardrail, query and write, optional snapshot: one date.

    A versioned target takes a date once per `run_id`; without one every call is a run of its own.
    """
    require_available(upstream, day)
    df = query(spark, day)
    rows, name = None, target.partition_field
    if target.versioned:
        run = run_id or uuid.uuid4().hex
        if name:
            rows = versions.replace_partition(df, target.table, name, day, run, fence)
        else:
            rows = versions.replace_table(df, target.table, run)
    elif name:
        rows = tables.replace_partition(df, target.table, name, day)
    else:
        tables.replace_table(df, target.table)
    if target.snapshot_folder is None:
        return None, rows
    path = f"{target.snapshot_folder}/{day.isoformat()}.{target.snapshot_suffix}"
    if target.versioned:
        return tables.save_copy(versions.read(spark, target.table, df.schema, name, day if name else None), path), rows
    return tables.snapshot(spark, target.table, name, day, path), rows


def assess_snapshot(spark: SparkSession, path: str, day: dt.date, target: Target) -> dict:
    """Measure a snapshot against earlier runs and append the record."""
    script = target.script.rsplit("/", 1)[-1]
    # The table's schema is known; inferring it would read a CSV twice.
    stored = versions.schema_of(spark, target.table) if target.versioned else spark.read.parquet(target.table).schema
    measures = quality.table_measures(tables.read_snapshot(spark, path, stored))
    baseline = quality.history_baseline(tables.load_history(spark, target.log), script)
    verdicts = quality.assess(measures, baseline).first().asDict()
    record = {
        "run_date": day.isoformat(),
        "target_table": target.table,
        "sql_file": script,
        **verdicts,
    }
    tables.append_run_record(spark, target.log, record)
    return record


def _summary(error: Exception) -> str:
    """First line of an error's text, or its kind if it has none."""
    return next(iter(str(error).splitlines()), "") or type(error).__name__


def _record(spark: SparkSession, path: str | None, day: dt.date, target: Target) -> None:
    """Assess the date's snapshot, or without one note the run only."""
    if path is not None:
        assess_snapshot(spark, path, day, target)
        return
    note = {"run_date": day.isoformat(), "target_table": target.table, "sql_file": target.script}
    tables.append_run_record(spark, target.log, note)


def run(
    spark: SparkSession,
    query: Query,
    target: Target,
    days: Sequence[dt.date],
    upstream: DataFrame | None = None,
) -> DataFrame:
    """Process each date; a failing date is reported and the next one still runs."""
    statuses = []
    for day in days:
        try:
            path, rows = extract(spark, query, day, target, upstream)
            _record(spark, path, day, target)
            statuses.append((day, True, rows, path, None))
        except Exception as error:  # one bad date must not stop the others
            statuses.append((day, False, None, None, _summary(error)))
    return spark.createDataFrame(statuses, STATUS_SCHEMA)


@dataclass(eq=False)
class _Attempt:
    """One date at work in a thread of its own, its Spark jobs under a tag of their own."""

    day: dt.date
    tag: str = field(default_factory=lambda: f"holdfast-{uuid.uuid4().hex}")
    began: float = field(default_factory=time.monotonic)
    path: str | None = None
    rows: int | None = None
    error: str | None = None
    published: bool = False
    given_up: bool = False
    lock: threading.Lock = field(default_factory=threading.Lock)

    def fence(self) -> None:
        """Called before the publication: a date that was given up publishes nothing."""
        with self.lock:
            if self.given_up:
                raise TimedOut("given up")
            self.published = True

    def give_up(self, seconds: float) -> None:
        with self.lock:
            self.given_up = True
            done = "its partition was published, what follows was not done" if self.published else "nothing was published"
            self.error = f"no end after {seconds:g} seconds; {done}"


def run_side_by_side(
    spark: SparkSession,
    query: Query,
    target: Target,
    days: Sequence[dt.date],
    upstream: DataFrame | None = None,
    workers: int = 4,
    time_limit: float = 3600.0,
    run_id: str | None = None,
) -> DataFrame:
    """Process dates `workers` at a time; statuses as of :func:`run`, in the order of `days`.

    A date that has not ended after `time_limit` seconds is given up: its jobs are cancelled, it is reported, its
    place goes to the next date, and whatever it still does is not published. So the whole takes at most
    time_limit * ceil(dates / workers). Assessments compare with earlier runs, so they are made in order
    when all dates have ended. Each date has a scheduler pool of its own: under `spark.scheduler.mode=FAIR`
    one that hangs doesn't take the cores from the others either. The target must be a versioned, partitioned table, where dates
    do not touch each other's files. Dates published under `run_id` before are not written again.
    """
    if not (target.versioned and target.partition_field):
        raise ValueError("Dates run side by side only into a versioned table with partitions.")
    context, ended = spark.sparkContext, queue.SimpleQueue()

    def work(attempt: _Attempt) -> None:
        context.addJobTag(attempt.tag)
        context.setLocalProperty("spark.scheduler.pool", attempt.tag)
        try:
            found = extract(spark, query, attempt.day, target, upstream, run_id, attempt.fence)
            with attempt.lock:
                if not attempt.given_up:
                    attempt.path, attempt.rows = found
        except Exception as error:  # one bad date must not stop the others
            with attempt.lock:
                attempt.error = attempt.error or _summary(error)
        finally:
            ended.put(attempt)

    waiting, active, stuck, attempts = list(reversed(days)), [], [], []
    while waiting or active:
        while waiting and len(active) < workers:
            attempt = _Attempt(waiting.pop())
            active.append(attempt)
            attempts.append(attempt)
            InheritableThread(target=work, args=(attempt,), daemon=True).start()
        patience = min(a.began for a in active) + time_limit - time.monotonic()
        try:
            done = ended.get(timeout=max(patience, 0.01))
            active = [a for a in active if a is not done]
        except queue.Empty:
            pass
        for attempt in [a for a in active if time.monotonic() - a.began >= time_limit]:
            attempt.give_up(time_limit)
            active.remove(attempt)
            stuck.append(attempt)
        for attempt in stuck:  # again each time: a date that hangs may have begun new jobs
            context.cancelJobsWithTag(attempt.tag)
    statuses = []
    for attempt in attempts:
        if attempt.error is None:
            try:
                _record(spark, attempt.path, attempt.day, target)
            except Exception as error:
                attempt.error = _summary(error)
        ok = attempt.error is None
        statuses.append((attempt.day, ok, attempt.rows if ok else None, attempt.path if ok else None, attempt.error))
    return spark.createDataFrame(statuses, STATUS_SCHEMA)
