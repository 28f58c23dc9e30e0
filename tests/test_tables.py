import datetime as dt

import pytest
from pyspark.sql import functions as F

from holdfast.operators import quality
from holdfast.plans import incremental
from holdfast.schemas import CALL_CENTER, RUN_LOG_FIELDS
from holdfast.sources import tables

A, B, C = dt.date(2026, 4, 5), dt.date(2026, 4, 12), dt.date(2026, 4, 19)


def frame(spark, rows):
    return spark.createDataFrame(rows, "d date, x bigint")


def content(spark, path):
    return sorted((r["d"], r["x"]) for r in spark.read.parquet(path).collect())


def test_replace_partition_touches_one_date(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.replace_partition(frame(spark, [(A, 1), (A, 2)]), path, "d", A) == 2
    assert tables.replace_partition(frame(spark, [(B, 3)]), path, "d", B) == 1
    assert tables.replace_partition(frame(spark, [(A, 9)]), path, "d", A) == 1
    assert content(spark, path) == [(A, 9), (B, 3)]


def test_empty_result_clears_its_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partition(frame(spark, [(A, 1)]), path, "d", A)
    tables.replace_partition(frame(spark, [(B, 2)]), path, "d", B)
    assert tables.replace_partition(frame(spark, []), path, "d", A) == 0
    assert content(spark, path) == [(B, 2)]
    assert tables.latest_partition(spark, path, "d") == B


def test_rows_of_another_date_fail_and_keep_the_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partition(frame(spark, [(A, 1)]), path, "d", A)
    for bad in (B, None):
        with pytest.raises(Exception, match="in partition"):
            tables.replace_partition(frame(spark, [(A, 5), (bad, 6)]), path, "d", A)
    assert content(spark, path) == [(A, 1)]


def test_latest_partition_of_nothing(spark, tmp_path):
    assert tables.latest_partition(spark, str(tmp_path / "none"), "d") is None
    tables.replace_table(spark.range(3), str(tmp_path / "t"))
    assert tables.latest_partition(spark, str(tmp_path / "t"), "d") is None


def test_csv_append_snapshot_and_export(spark, tmp_path):
    path, csv = str(tmp_path / "calls"), str(tmp_path / "csv")
    calls = spark.createDataFrame([("A", "s", A, 0), ("B", None, None, 1)], CALL_CENTER)
    tables.export_csv(calls, csv)
    tables.append_csv(spark, csv, CALL_CENTER, path)
    tables.append_csv(spark, csv, CALL_CENTER, path)
    assert spark.read.parquet(path).count() == 4
    for suffix in ("parquet", "csv"):
        copy = tables.snapshot(spark, path, "event_date", A, str(tmp_path / f"copy.{suffix}"))
        assert tables.read_snapshot(spark, copy).count() == 2
    whole = tables.snapshot(spark, path, None, None, str(tmp_path / "whole.csv"))
    assert tables.read_snapshot(spark, whole, CALL_CENTER).schema == calls.schema


def test_run_date_parameter(spark):
    df = frame(spark, [(A, 1), (B, 2)])
    got = tables.run_query(spark, "select x from {t} where d = :run_date", B, t=df)
    assert [r["x"] for r in got.collect()] == [2]


def test_run_log_round_trip(spark, tmp_path):
    log = str(tmp_path / "log")
    assert tables.load_history(spark, log).count() == 0
    record = {"run_date": "2026-04-05", "target_table": "t", "sql_file": "a/b.sql", "row_count": 5}
    tables.append_run_record(spark, log, record)
    row = tables.load_history(spark, log).first()
    assert tuple(row.asDict()) == RUN_LOG_FIELDS
    assert (row["sql_file"], row["row_count"], row["nulls_passed"]) == ("b.sql", 5, None)


def test_null_percentage(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert tuple(quality.table_measures(df).first()) == (2, 75.0)
    assert tuple(quality.table_measures(df.limit(0)).first()) == (0, 0.0)


@pytest.mark.parametrize(
    "current,average,passed",
    [(110.0, 100.0, True), (110.1, 100.0, False), (89.9, 100.0, False), (5.0, 0.0, True), (5.0, None, True)],
)
def test_deviation(spark, current, average, passed):
    df = spark.createDataFrame([(current, average)], "c double, a double")
    assert df.select(quality.within_deviation("c", "a")).first()[0] is passed


def test_population_contract(spark):
    good = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, m double")
    quality.require_valid_population(good, "k", ["m"])
    bad_keys = [[("a", 1.0), ("a", 2.0)], [(None, 1.0)]]
    for rows in bad_keys:
        with pytest.raises(ValueError, match="unique"):
            quality.require_valid_population(spark.createDataFrame(rows, good.schema), "k", ["m"])
    with pytest.raises(ValueError, match="empty"):
        quality.require_valid_population(good.limit(0), "k", ["m"])
    with pytest.raises(ValueError, match="any value"):
        quality.require_valid_population(good.where("k = 'b'"), "k", ["m"])


def target(tmp_path, **changes):
    options = dict(
        table=str(tmp_path / "t"), script="sql/weekly.sql", log=str(tmp_path / "log"), partition_field="d"
    )
    return incremental.Target(**{**options, **changes})


def test_guardrail(spark):
    upstream = spark.createDataFrame([(A,)], "inference_date date")
    incremental.require_available(upstream, A)
    incremental.require_available(None, B)
    with pytest.raises(incremental.DataNotReady):
        incremental.require_available(upstream, B)
    assert [incremental.available(upstream, d).first()[0] for d in (A, B)] == [True, False]


def test_catch_up_dates(spark, tmp_path):
    t = target(tmp_path)
    run = lambda **k: incremental.dates_to_run(spark, "2026-04-21", "sunday", k.pop("t", t), **k)
    assert run() == ([C], None)
    assert run(catch_up=True)[0] == [C] and "no loaded partition" in run(catch_up=True)[1]
    assert "not partitioned" in run(t=target(tmp_path, partition_field=None), catch_up=True)[1]
    tables.replace_partition(frame(spark, [(A, 1)]), t.table, "d", A)
    assert run(catch_up=True) == ([B, C], None)
    tables.replace_partition(frame(spark, [(C, 1)]), t.table, "d", C)
    assert run(catch_up=True) == ([C], "no date is missing")


def test_run_isolates_errors_assesses_and_logs(spark, tmp_path):
    sizes = {A: 10, B: 10, C: 12}

    def query(session, day):
        if day == B:
            raise RuntimeError("boom")
        return session.range(sizes[day]).select(F.lit(day).alias("d"), F.col("id").alias("x"))

    t = target(tmp_path, snapshot_folder=str(tmp_path / "snap"))
    status = {r["run_date"]: r for r in incremental.run(spark, query, t, [A, B, C]).collect()}
    assert [status[d]["ok"] for d in (A, B, C)] == [True, False, True]
    assert status[B]["error"] == "boom" and status[C]["rows"] == 12
    history = {r["run_date"]: r for r in tables.load_history(spark, t.log).collect()}
    assert set(history) == {"2026-04-05", "2026-04-19"}
    assert history["2026-04-05"]["row_count_passed"]  # no history yet
    assert history["2026-04-19"]["row_count_passed"] is False  # 20 % more than before
    assert history["2026-04-19"]["nulls_passed"] is True
    assert history["2026-04-19"]["sql_file"] == "weekly.sql"


def test_run_without_snapshot_only_logs(spark, tmp_path):
    t = target(tmp_path, partition_field=None)
    upstream = spark.createDataFrame([(A,)], "inference_date date")
    query = lambda session, day: session.range(3).toDF("x")
    status = incremental.run(spark, query, t, [A, B], upstream).orderBy("run_date").collect()
    assert [r["ok"] for r in status] == [True, False]
    rows = tables.load_history(spark, t.log).collect()
    assert [(r["run_date"], r["row_count"]) for r in rows] == [("2026-04-05", None)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y")], "m double, s string")
    row = quality.table_measures(df).first()
    assert (row["row_count"], row["null_percentage"]) == (3, 50.0)


def test_latest_partition_is_read_from_folder_names(spark, tmp_path):
    """Neither a damaged data file nor an emptied partition matters."""
    table = f"{tmp_path}/daily"
    days = [(dt.date(2024, 1, d), d) for d in (3, 9, 12)]
    spark.createDataFrame(days, "day date, n int").write.partitionBy("day").parquet(table)
    none = spark.createDataFrame([], "day date, n int")
    tables.replace_partition(none, table, "day", dt.date(2024, 1, 12))
    for file in (tmp_path / "daily").glob("*/*.parquet"):
        file.write_bytes(b"damaged")
    assert tables.latest_partition(spark, table, "day") == dt.date(2024, 1, 9)
    assert tables.latest_partition(spark, table, "other") is None
    assert tables.latest_partition(spark, f"{table}-absent", "day") is None


def test_staging_scope_deletes_its_folder(spark):
    import os

    with tables.staging(spark) as folder:
        staged = tables.stage(spark.range(5).toDF("n"))
        assert staged.count() == 5 and os.path.isdir(folder)
        assert tables.scratch_path(spark, "x").startswith(folder)
    assert not os.path.exists(folder)
    assert tables.stage(spark.range(2).toDF("n")).count() == 2


def test_settled_result_outlives_what_it_was_made_from(spark):
    made = []

    def build():
        made.append(tables.stage(spark.range(5).toDF("n")))
        return made[0].where("n > 2")

    kept = tables.settle(spark, build)
    assert sorted(r["n"] for r in kept.collect()) == [3, 4]
    with pytest.raises(Exception, match="(?i)exist|not found"):
        made[0].count()


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString("\n").split("\n")
    return {n for n in names if n.rsplit("/", 1)[-1].startswith("shuffle_")}


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    import time

    counts = spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count()
    before = _shuffle_files(spark)
    with tables.shuffles_freed(spark):
        freed = tables.stage(counts)
        for _ in range(50):
            if not _shuffle_files(spark) - before:
                break
            time.sleep(0.2)
        assert not _shuffle_files(spark) - before
    kept = tables.stage(counts)
    assert _shuffle_files(spark) - before
    assert sorted(freed.collect()) == sorted(kept.collect()) and freed.count() == 7


def test_overlapping_scopes_restore_the_setting(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    at_first = spark.conf.get(setting, None)
    one, two = tables.shuffles_freed(spark), tables.shuffles_freed(spark)
    one.__enter__()
    two.__enter__()
    assert spark.conf.get(setting) == "true"
    one.__exit__(None, None, None)
    assert spark.conf.get(setting) == "true"
    two.__exit__(None, None, None)
    assert spark.conf.get(setting, None) == at_first


def test_errors_without_text_are_reported_by_kind():
    assert incremental._summary(RuntimeError()) == "RuntimeError"
    assert incremental._summary(ValueError("first\nsecond")) == "first"
    assert incremental._summary(KeyError("")) == "''"
