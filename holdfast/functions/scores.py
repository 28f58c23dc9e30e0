"""Robust scaling and cross-metric summaries as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(value: Column, low: Column, high: Column) -> Column:
    """Clip to [low, high]; a missing value stays missing, a missing bound is open."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def robust_score(value: Column, low: Column, high: Column, center: Column, spread: Column) -> Column:
    return (clip(value, low, high) - center) / spread


def _is_finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def magnitude(values: Sequence[Column]) -> Column:
    """Euclidean length over the finite parts; NULL when there are none."""
    squares = [F.when(_is_finite(v), v * v).otherwise(0.0) for v in values]
    any_finite = reduce(lambda a, b: a | b, [_is_finite(v) for v in values])
    return F.when(any_finite, F.sqrt(reduce(lambda a, b: a + b, squares)))


def dominant(named: dict[str, Column]) -> Column:
    """Name of the largest absolute value, the earliest name on ties."""
    entries = F.array(
        *[
            F.struct(F.abs(v).alias("size"), F.lit(-i).alias("order"), F.lit(name).alias("name"))
            for i, (name, v) in enumerate(named.items())
        ]
    )
    present = F.filter(entries, lambda e: e["size"].isNotNull() & ~F.isnan(e["size"]))
    return F.array_max(present)["name"]
