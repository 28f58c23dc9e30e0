"""Run dates, Sunday-aligned weeks and the inference / email calendar."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL_LAG_DAYS = 5

# The two first mailing files that used an earlier inference week.
FILE_DATE_OVERRIDES = {
    dt.date(2026, 4, 8): dt.date(2026, 3, 29),
    dt.date(2026, 4, 9): dt.date(2026, 4, 5),
}
# First day of the experiment and the agreed maturity cutoff.
EXPERIMENT_START = dt.date(2026, 4, 3)
MATURITY_CUTOFF = dt.date(2026, 5, 1)

STEP_DAYS = {"exact": 1, "sunday": 7}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _step(mode: str) -> int:
    try:
        return STEP_DAYS[mode.lower()]
    except KeyError:
        raise ValueError(
            f"Unknown date mode {mode!r}; expected 'exact' or 'sunday'."
        ) from None


def sunday_on_or_before(day: Column | str) -> Column:
    """Start of the Sunday-based week containing `day`."""
    day = _col(day)
    return F.date_sub(day, F.dayofweek(day) - 1)


def target_date(run_date: dt.date | str, mode: str) -> dt.date:
    """Date a run writes: the run date itself, or the Sunday on or before it."""
    day = dt.date.fromisoformat(run_date) if isinstance(run_date, str) else run_date
    if _step(mode) == 1:
        return day
    return day - dt.timedelta(days=day.isoweekday() % 7)


def target_date_col(run_date: Column | str, mode: str) -> Column:
    """Column form of :func:`target_date`."""
    return _col(run_date) if _step(mode) == 1 else sunday_on_or_before(run_date)


def missing_dates(start: dt.date, end: dt.date, mode: str) -> list[dt.date]:
    """Dates after `start` up to and including `end`, one run step apart."""
    step = _step(mode)
    count = max((end - start).days // step, 0)
    return [start + dt.timedelta(days=step * i) for i in range(1, count + 1)]


def missing_dates_col(start: Column | str, end: Column | str, mode: str) -> Column:
    """Array form of :func:`missing_dates`; empty when nothing is missing."""
    step = _step(mode)
    first, last = F.date_add(_col(start), step), _col(end)
    interval = F.make_dt_interval(F.lit(step))
    return F.when(
        first <= last, F.sequence(first, last, interval)
    ).otherwise(F.array().cast("array<date>"))


def floor_date(day: Column | str, start: dt.date = EXPERIMENT_START) -> Column:
    """Clamp a run date to the experiment start."""
    return F.greatest(F.lit(start), _col(day))


def inference_date(
    file_date: Column | str,
    overrides: Mapping[dt.date, dt.date] = FILE_DATE_OVERRIDES,
) -> Column:
    """Inference week of a mailing file: an override, else its Sunday."""
    file_date = _col(file_date)
    result = sunday_on_or_before(file_date)
    for source, target in overrides.items():
        result = F.when(file_date == F.lit(source), F.lit(target)).otherwise(result)
    return result


def email_date(inference: Column | str) -> Column:
    """Day the pricing notification goes out."""
    return F.date_add(_col(inference), EMAIL_LAG_DAYS)
