"""Versioned tables and exactly-once loads, ended by force between any two steps."""

import datetime as dt
import os

import pytest

from holdfast.schemas import CALL_CENTER
from holdfast.sources import loads, versions

A, B = dt.date(2026, 4, 5), dt.date(2026, 4, 12)
SCHEMA = "d date, x bigint"


class Killed(RuntimeError):
    pass


def kill(monkeypatch, module, name, after=False):
    """Make a step raise, before or after it has done its work."""
    real = getattr(module, name)

    def step(*args):
        if after:
            real(*args)
        raise Killed(name)

    monkeypatch.setattr(module, name, step)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, table, **at):
    return sorted((r["d"], r["x"]) for r in versions.read(spark, table, SCHEMA, "d", **at).collect())


# --- versions ---------------------------------------------------------------------


def test_partition_versions(spark, tmp_path):
    t = str(tmp_path / "t")
    assert content(spark, t) == [] and versions.latest(spark, t, "d") is None
    assert versions.replace_partition(frame(spark, [(A, 1), (A, 2)]), t, "d", A, "r1") == 2
    assert versions.replace_partition(frame(spark, [(B, 3)]), t, "d", B, "r1") == 1
    assert versions.replace_partition(frame(spark, [(A, 9)]), t, "d", A, "r2") == 1
    assert content(spark, t) == [(A, 9), (B, 3)] and content(spark, t, day=B) == [(B, 3)]
    assert versions.replace_partition(frame(spark, []), t, "d", B, "r3") == 0
    assert content(spark, t) == [(A, 9)] and versions.latest(spark, t, "d") == A


def test_repeated_run_does_nothing(spark, tmp_path):
    t = str(tmp_path / "t")
    versions.replace_partition(frame(spark, [(A, 1)]), t, "d", A, "r1")
    versions.replace_partition(frame(spark, [(A, 2)]), t, "d", A, "r2")
    assert versions.replace_partition(frame(spark, [(A, 7), (A, 8)]), t, "d", A, "r1") == 1
    assert content(spark, t) == [(A, 2)] and len(versions.publications(spark, t)) == 2
    with pytest.raises(ValueError, match="run id"):
        versions.replace_partition(frame(spark, []), t, "d", A, "a/b")


@pytest.mark.parametrize("step,after", [("write_version", False), ("write_version", True), ("publish", False)])
@pytest.mark.parametrize("rows", [[(A, 5), (A, 6)], []])
def test_killed_write_leaves_the_old_partition(spark, tmp_path, monkeypatch, step, after, rows):
    t = str(tmp_path / "t")
    versions.replace_partition(frame(spark, [(A, 1)]), t, "d", A, "old")
    with monkeypatch.context() as patch:
        kill(patch, versions, step, after)
        with pytest.raises(Killed):
            versions.replace_partition(frame(spark, rows), t, "d", A, "new")
        assert content(spark, t) == [(A, 1)] and versions.latest(spark, t, "d") == A
    assert versions.replace_partition(frame(spark, rows), t, "d", A, "new") == len(rows)
    assert content(spark, t) == rows


def test_killed_after_publication_is_done(spark, tmp_path, monkeypatch):
    t = str(tmp_path / "t")
    with monkeypatch.context() as patch:
        kill(patch, versions, "publish", after=True)
        with pytest.raises(Killed):
            versions.replace_partition(frame(spark, [(A, 5)]), t, "d", A, "new")
    assert content(spark, t) == [(A, 5)]
    assert versions.replace_partition(frame(spark, [(A, 6)]), t, "d", A, "new") == 1
    assert content(spark, t) == [(A, 5)]


def test_failing_query_and_wrong_dates(spark, tmp_path):
    t = str(tmp_path / "t")
    versions.replace_partition(frame(spark, [(A, 1)]), t, "d", A, "r1")
    for wrong in (B, None):
        with pytest.raises(Exception, match="in partition 2026-04-05"):
            versions.replace_partition(frame(spark, [(A, 5), (wrong, 6)]), t, "d", A, "r2")
    assert content(spark, t) == [(A, 1)]


def test_whole_table_roll_back_and_vacuum(spark, tmp_path):
    t = str(tmp_path / "t")
    for k in range(4):
        versions.replace_table(frame(spark, [(A, k)]), t, f"r{k}")
    whole = lambda: [r["x"] for r in versions.read(spark, t, SCHEMA).collect()]
    assert whole() == [3]
    versions.roll_back(spark, t, None, None, "r1")
    assert whole() == [1]
    with pytest.raises(ValueError, match="never"):
        versions.roll_back(spark, t, None, None, "r9")
    assert versions.vacuum(spark, t, keep=2) == 0  # too young
    assert versions.vacuum(spark, t, keep=2, older_than=dt.timedelta(0)) == 2
    assert whole() == [1] and sorted(os.listdir(tmp_path / "t/data/all")) == ["version=r1", "version=r3"]


def test_two_writers_of_one_order(spark, tmp_path):
    t = str(tmp_path / "t")
    for run in ("b", "a"):
        p = versions.Publication("d=2026-04-05", 4, run, versions.write_version(frame(spark, [(A, ord(run))]), f"{t}/data/d=2026-04-05/version={run}"))
        versions.publish(spark, t, p)
    assert content(spark, t) == [(A, ord("b"))]


# --- loads ------------------------------------------------------------------------

HEADER = "Account,idSubscrip,event_date,Saves__Digital_to_Digital_"
GOOD = ["A,1,2026-04-05,0", "B,,2026-04-06,1", "C,3,,"]
BAD = ["D,4,not a date,1", "E,5,2026-04-05,one", "F,6,2026-04-05,1,extra", "short"]


def put(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([HEADER, *lines]) + "\n")


def rows_of(spark, table):
    good = sorted(r["Account"] for r in loads.read(spark, table, CALL_CENTER).collect())
    return good, sorted(r["line"] for r in loads.quarantine(spark, table, CALL_CENTER).collect())


def test_folder_is_loaded_once(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "t")
    put(source, "one.csv", GOOD + BAD)
    report = loads.load_files(spark, str(source), CALL_CENTER, table)
    assert (report.files, report.good, report.quarantined) == (1, 3, 4)
    assert rows_of(spark, table) == (["A", "B", "C"], sorted(BAD))
    assert loads.load_files(spark, str(source), CALL_CENTER, table) == loads.Report(None, 0, 0, 0)
    put(source / "deeper", "two.csv", ["G,7,2026-04-07,0", "odd,line"])
    report = loads.load_files(spark, str(source), CALL_CENTER, table)
    assert (report.files, report.good, report.quarantined) == (1, 1, 1)
    good, bad = rows_of(spark, table)
    assert len(good) + len(bad) == len(GOOD) + len(BAD) + 2
    assert loads.read(spark, table, CALL_CENTER).schema == spark.createDataFrame([], CALL_CENTER).schema
    names = {r["file"].rsplit("/", 1)[-1] for r in loads.quarantine(spark, table, CALL_CENTER).collect()}
    assert names == {"one.csv", "two.csv"}


def test_changed_file_is_a_new_one(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "t")
    put(source, "one.csv", GOOD)
    loads.load_files(spark, str(source), CALL_CENTER, table)
    put(source, "one.csv", ["Z,9,2026-04-09,0"])
    assert loads.load_files(spark, str(source), CALL_CENTER, table).good == 1
    assert rows_of(spark, table)[0] == ["A", "B", "C", "Z"]


@pytest.mark.parametrize(
    "step,after",
    [("write_rows", False), ("write_rows", True), ("write_ledger", False), ("write_ledger", True), ("publish", False)],
)
def test_killed_load_is_done_over(spark, tmp_path, monkeypatch, step, after):
    source, table = tmp_path / "in", str(tmp_path / "t")
    put(source, "one.csv", GOOD)
    loads.load_files(spark, str(source), CALL_CENTER, table)
    put(source, "two.csv", ["G,7,2026-04-07,0", *BAD])
    with monkeypatch.context() as patch:
        kill(patch, loads, step, after)
        with pytest.raises(Killed):
            loads.load_files(spark, str(source), CALL_CENTER, table)
        assert rows_of(spark, table) == (["A", "B", "C"], [])
    assert loads.load_files(spark, str(source), CALL_CENTER, table).quarantined == 4
    assert rows_of(spark, table) == (["A", "B", "C", "G"], sorted(BAD))
    assert len(loads.published(spark, table)) == 2


def test_killed_after_publication_loads_nothing_more(spark, tmp_path, monkeypatch):
    source, table = tmp_path / "in", str(tmp_path / "t")
    put(source, "one.csv", GOOD)
    with monkeypatch.context() as patch:
        kill(patch, loads, "publish", after=True)
        with pytest.raises(Killed):
            loads.load_files(spark, str(source), CALL_CENTER, table)
    assert loads.load_files(spark, str(source), CALL_CENTER, table).files == 0
    assert rows_of(spark, table)[0] == ["A", "B", "C"]


def test_nothing_loaded(spark, tmp_path):
    source, table = tmp_path / "in", str(tmp_path / "t")
    assert rows_of(spark, table) == ([], [])
    put(source, "none.csv", [])
    report = loads.load_files(spark, str(source), CALL_CENTER, table)
    assert (report.files, report.good, report.quarantined) == (1, 0, 0)
    assert loads.load_files(spark, str(source), CALL_CENTER, table).files == 0
    assert rows_of(spark, table) == ([], [])
