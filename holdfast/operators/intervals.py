"""Joins against effective-dated tables.

Facts are not paired with every version of their key. The days on which a key has facts are one bit each,
64 days a cell (key, bucket of days). A version is cut into the buckets it covers and meets
a cell once: the bits between its start and its end are the days it is needed for, and only those are
spread out. Facts then meet these (key, day, version) rows by equality alone, so every row that the joins
make belongs to the result, and a key with very many facts or versions is dealt over its buckets and days.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Days of a bucket: bits of a long.
BUCKET = 64


def _keys(on: Sequence[str]) -> list[Column]:
    return [F.col(f"`{key}`").alias(f"k{i}") for i, key in enumerate(on)]


def _names(on: Sequence[str]) -> list[str]:
    return [f"k{i}" for i in range(len(on))]


def _kept(versions: DataFrame, on: Sequence[str], start: str, end: str) -> list[str]:
    return [c for c in versions.columns if c not in (*on, start, end)]


def _packed(versions: DataFrame, on: Sequence[str], start: str, end: str) -> Column:
    """What a version brings to the result, as one column, so that no name clashes."""
    kept = [F.col(f"`{c}`") for c in _kept(versions, on, start, end)]
    return F.struct(*(kept or [F.lit(True).alias("valid")])).alias("version")


def _bucket(day: Column) -> Column:
    return F.floor(day / BUCKET).cast("int")


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def fact_cells(facts: DataFrame, on: Sequence[str], date: str) -> DataFrame:
    """(k0, ..., bucket, days): the days of a bucket on which a key has facts, as bits of one long."""
    day = F.unix_date(F.col(f"`{date}`"))
    bit = F.expr(f"shiftleft(1L, cast(pmod(day, {BUCKET}) as int))")
    return (
        facts.select(*_keys(on), day.alias("day"))
        .where(F.col("day").isNotNull())
        .groupBy(*_names(on), _bucket(F.col("day")).alias("bucket"))
        .agg(F.bit_or(bit).alias("days"))
    )


def version_spans(
    versions: DataFrame, on: Sequence[str], start: str, end: str, low: Column, high: Column
) -> DataFrame:
    """(k0, ..., bucket, first, last, version): a version once for each bucket of its validity.

    Validity is clipped to the days [low, high] that have facts, so an open end costs no more than
    those. Versions without a start or an end, or that end before they start, are valid never.
    """
    begins, ends = F.unix_date(F.col(f"`{start}`")), F.unix_date(F.col(f"`{end}`"))
    return (
        versions.select(*_keys(on), begins.alias("first"), ends.alias("last"), _packed(versions, on, start, end))
        .where("first is not null and last is not null")
        .withColumns({"first": F.greatest("first", low), "last": F.least("last", high)})
        .where("first <= last")
        .select(
            *_names(on), "first", "last", "version",
            F.explode(F.sequence(_bucket(F.col("first")), _bucket(F.col("last")))).alias("bucket"),
        )
    )


def version_days(spans: DataFrame, cells: DataFrame, on: Sequence[str]) -> DataFrame:
    """(k0, ..., day, version) for each day of a version on which its key has facts."""
    base = F.col("bucket") * BUCKET
    low, high = F.greatest(F.col("first") - base, F.lit(0)), F.least(F.col("last") - base, F.lit(BUCKET - 1))
    span = F.expr("shiftleft(-1L, low)").bitwiseAND(F.expr(f"shiftrightunsigned(-1L, {BUCKET - 1} - high)"))
    places = F.filter(
        F.sequence(F.col("low"), F.col("high")), lambda k: F.getbit(F.col("days"), k) == F.lit(1)
    )
    return (
        spans.join(cells, [*_names(on), "bucket"])
        .withColumns({"low": low, "high": high})
        .where(span.bitwiseAND(F.col("days")) != 0)
        .select(*_names(on), "version", F.explode(places).alias("place"), "bucket")
        .select(*_names(on), (F.col("bucket") * BUCKET + F.col("place")).alias("day"), "version")
    )


def effective_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    date: str,
    start: str = "effective_date",
    end: str = "end_date",
    how: str = "inner",
    day: dt.date | None = None,
) -> DataFrame:
    """Match each fact to the versions of its key that were valid on its date.

    Both bounds are inclusive; dates are dates, not timestamps. `how` is inner or left. Validity columns
    are dropped. Facts without a date, null keys and versions with an open bound (null) match nothing.
    Where all facts are of one known `day`, validity is a filter on the versions, and no facts are surveyed.
    """
    kept = _kept(versions, on, start, end)
    if day is not None:
        current = versions.where(F.lit(day).between(F.col(f"`{start}`"), F.col(f"`{end}`")))
        since_epoch = F.lit((day - dt.date(1970, 1, 1)).days)
        dated = current.select(*_keys(on), since_epoch.alias("day"), _packed(versions, on, start, end))
    else:
        dates = facts.select(F.unix_date(F.col(f"`{date}`")).alias("day"))
        low, high = dates.agg(F.min("day")).scalar(), dates.agg(F.max("day")).scalar()
        spans = version_spans(versions, on, start, end, low, high)
        dated = version_days(spans, fact_cells(facts, on, date), on)
    f, v = facts.alias("f"), dated.alias("v")
    same = [F.col(f"f.`{key}`") == F.col(f"v.{name}") for key, name in zip(on, _names(on), strict=True)]
    same.append(F.unix_date(F.col(f"f.`{date}`")) == F.col("v.day"))
    return f.join(v, _all(same), how).select("f.*", *[F.col(f"v.version.`{c}`") for c in kept])
