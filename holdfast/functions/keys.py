"""Business keys and null-safe key joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The Unicode White_Space characters. `trim` on its own only
# strips U+0020, while account keys are defined as stripped of any whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def account_key(col: Column | str) -> Column:
    """Normalised billing account: whitespace stripped on both ends, lower case."""
    col = F.col(col) if isinstance(col, str) else col
    return F.lower(F.btrim(col, F.lit(WHITESPACE)))


def nan_to_null(col: Column | str) -> Column:
    """Metric as double with NaN treated as missing."""
    col = F.col(col) if isinstance(col, str) else col
    return F.nullif(col.cast("double"), F.lit(float("nan")))


def null_safe_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join where a missing key equals a missing key; keys are kept once.

    Catalyst rewrites each `<=>` into hashable keys, so this still plans as a
    hash or sort-merge join.
    """
    renamed = right.select(
        *[F.col(f"`{c}`").alias(f"__r_{c}" if c in on else c) for c in right.columns]
    )
    condition = reduce(
        lambda a, b: a & b,
        [left[f"`{c}`"].eqNullSafe(renamed[f"`__r_{c}`"]) for c in on],
    )
    joined = left.join(renamed, condition, how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__r_{c}" for c in on])
