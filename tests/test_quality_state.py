"""Quality measures kept per partition: equal to measuring the whole table, and only changed partitions are read."""

import datetime as dt

import pytest

from holdfast.operators import quality, quality_state
from holdfast.sources import versions

SCHEMA = "day date, id long, name string, x double"
DAYS = [dt.date(2024, 3, d) for d in range(1, 5)]


def rows_of(day, shift=0):
    n = DAYS.index(day)
    rows = [(day, 10 * n + i + shift, None if i % 3 == 0 else "b", float("nan") if i % 4 == 0 else 1.0) for i in range(6)]
    return [*rows, (day, None, "null key", None)] if n == 2 else rows


@pytest.fixture
def world(spark, tmp_path):
    class World:
        table, state = str(tmp_path / "table"), str(tmp_path / "state")
        schema = spark.createDataFrame([], SCHEMA).schema
        rows = {}

        def put(self, day, rows, run):
            self.rows[day] = rows
            versions.replace_partition(spark.createDataFrame(rows, SCHEMA), self.table, "day", day, run)

        def refresh(self):
            return quality_state.refresh(spark, self.table, self.schema, "day", self.state, ["id"])

        def check(self):
            """Merged results are those of the rows as one table."""
            whole = spark.createDataFrame([r for rows in self.rows.values() for r in rows], SCHEMA)
            got = quality_state.merged_measures(spark, self.schema, "day", self.state).first()
            want = quality.table_measures(whole).first()
            assert got["row_count"] == want["row_count"]
            assert got["null_percentage"] == pytest.approx(want["null_percentage"])
            bad = quality_state.merged_violations(spark, self.schema, "day", self.state, ["id"])
            assert sorted(map(str, bad.collect())) == sorted(map(str, quality.key_violations(whole, "id").collect()))

    world = World()
    for day in DAYS:
        world.put(day, rows_of(day), "load")
    return world


def test_merged_results_and_what_is_read(spark, world, monkeypatch):
    assert world.refresh() == [f"day={d}" for d in DAYS]
    world.check()
    assert world.refresh() == []
    read = []
    plain = versions.read
    monkeypatch.setattr(versions, "read", lambda *a: read.append(a[4:]) or plain(*a))
    world.put(DAYS[1], rows_of(DAYS[1], shift=10), "again")  # its keys now repeat those of the third day
    assert world.refresh() == [f"day={DAYS[1]}"]
    assert read == [(DAYS[1],)]
    monkeypatch.undo()
    world.check()
    assert quality_state.merged_violations(spark, world.schema, "day", world.state, ["id"]).count() == 7


def test_emptied_and_rolled_back_partitions(spark, world):
    world.refresh()
    world.put(DAYS[0], [], "empty")
    assert world.refresh() == [f"day={DAYS[0]}"]
    world.check()
    versions.roll_back(spark, world.table, "day", DAYS[0], "load")
    world.rows[DAYS[0]] = rows_of(DAYS[0])
    assert world.refresh() == [f"day={DAYS[0]}"]
    world.check()


def test_a_refresh_that_was_ended_is_done_over(world, monkeypatch):
    write = versions.bring_back
    calls = []

    def fail_at_the_fourth(*args):
        calls.append(args)
        if len(calls) == 4:
            raise RuntimeError("ended")
        write(*args)

    monkeypatch.setattr(versions, "bring_back", fail_at_the_fourth)
    with pytest.raises(RuntimeError, match="ended"):
        world.refresh()
    monkeypatch.undo()
    assert world.refresh() == [f"day={d}" for d in DAYS[1:]]  # the second has its keys and no measures
    world.check()


def test_missing_by_column_several_keys_and_nothing_at_all(spark, world, tmp_path):
    assert quality_state.merged_measures(spark, world.schema, "day", world.state).first().asDict() == {"row_count": 0, "null_percentage": 0.0}
    world.refresh()
    found = {r["column"]: (r["missing"], r["rows"]) for r in quality_state.missing_by_column(spark, "day", world.state).collect()}
    assert found == {"day": (0, 25), "id": (1, 25), "name": (8, 25), "x": (9, 25)}
    both = str(tmp_path / "both")
    quality_state.refresh(spark, world.table, world.schema, "day", both, ["day", "name"])
    bad = quality_state.merged_violations(spark, world.schema, "day", both, ["day", "name"]).collect()
    assert sorted((r["day"], r["name"] or "", r["rows"]) for r in bad) == sorted((d, n, k) for d in DAYS for n, k in (("", 2), ("b", 4)))
