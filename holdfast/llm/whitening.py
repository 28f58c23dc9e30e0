"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation of the centred rows.

With A the matrix of distinct centred vectors, A V = U B and Aᵀ U = V Bᵀ for orthonormal V and U and an upper
bidiagonal B; the small SVD of B gives A's right singular vectors (the components) and singular values.
Each step is one pass over the rows, which makes A v and Aᵀ u together. A left vector has an entry per row
and is never stored: it is A w for a w with an entry per dimension, so tasks make it anew from their rows,
and a lost executor loses nothing. Tasks send sums of fixed size, which Spark adds up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.sources.tables import stage

# Entries become whole numbers floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Larger entries, like infinite ones, take a vector out: their whole numbers would not be exact.
LARGEST = 2.0**40
#: Singular values below this share of the largest count as zero.
NOTHING = 1e-7
RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Centre:
    """n vectors with exact sums: `middle` is the nearest whole mean, `rest` = sums - n * middle."""

    n: int
    middle: np.ndarray
    rest: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, as exact as doubles are."""
        return (x - self.middle) - self.rest / self.n

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - sums) ** 2 of each row, exactly; None where no long holds it."""
        off, top = x - self.middle, 2**63
        most = max(int(np.abs(off).max(initial=0)) * self.n + int(np.abs(self.rest).max(initial=0)), 1)
        exact = off if most * most * max(x.shape[1], 1) < top else off.astype(object)
        found = ((exact * self.n - self.rest) ** 2).sum(axis=1)
        return [int(v) if int(v) < top else None for v in found]


@dataclass
class Bidiagonal:
    """What the driver knows of the recurrence: per step a right vector v, w with u = A w, Aᵀ u, alpha, beta."""

    v: list[np.ndarray] = field(default_factory=list)
    w: list[np.ndarray] = field(default_factory=list)
    back: list[np.ndarray] = field(default_factory=list)
    alpha: list[float] = field(default_factory=list)
    beta: list[float] = field(default_factory=list)

    def matrix(self) -> np.ndarray:
        return np.diag(self.alpha) + np.diag(self.beta[: len(self.alpha) - 1], 1)

    def fresh(self, rng: np.random.Generator, d: int) -> np.ndarray:
        """A random unit vector orthogonal to all right vectors so far."""
        return _unit(_clear(rng.standard_normal(d), self.v))


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    components: np.ndarray  # one per column
    values: np.ndarray  # eigenvalues of the covariance, falling
    trace: float

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.components / np.sqrt(self.values)


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v)


def _clear(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """v without its parts along orthonormal vectors; twice, so that rounding leaves none."""
    if others:
        basis = np.array(others)
        for _ in range(2):
            v = v - basis.T @ (basis @ v)
    return v


def _rows(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _totals(fit: DataFrame, d: int, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of the `width` numbers that `part` makes of a block of rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for batch in batches:
            total += part(_rows(batch, d))
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total)], ["place", "value"])

    found = fit.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    out = np.zeros(width)
    for row in found.collect():  # one row a place
        out[row["place"]] = row["value"]
    return out


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of rows whose vector has neither null nor non-finite entries; x are whole numbers."""
    entries = F.col("entries")
    bad = F.exists(entries, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) > LARGEST))
    return (
        rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("entries"))
        .where(entries.isNotNull() & ~bad & (F.size(entries) > 0))
        .select("vec_id", F.transform(entries, lambda c: F.floor(c * SCALE).cast("long") + SHIFT).alias("x"))
    )


def one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """Rows whose vectors have the most common length (the longest, if several), and it; 0 without rows."""
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    d = lengths[0]["d"] if lengths else 0
    return rows.where(F.size("x") == d), d


def centre_of(fit: DataFrame, d: int) -> Centre:
    """Count and exact sums; halves of 32 bits are added apart, so nothing overflows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * d + 1, np.int64)
        for batch in batches:
            x = _rows(batch, d)
            total += np.concatenate([(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0), [len(x)]])
        yield pa.RecordBatch.from_arrays([pa.array(range(2 * d + 1), pa.int32()), pa.array(total)], ["place", "value"])

    added = F.sum(F.col("value").cast("decimal(20,0)")).alias("value")
    found = fit.mapInArrow(run, "place int, value long").groupBy("place").agg(added).collect()
    value = [0] * (2 * d + 1)
    for row in found:
        value[row["place"]] = int(row["value"] or Decimal(0))
    n, sums = value[-1], [high * 2**32 + low for high, low in zip(value[:d], value[d : 2 * d], strict=True)]
    middle = [s // n if n else 0 for s in sums]
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    return Centre(n, np.array(middle, np.int64), np.array(rest, np.int64))


def bidiagonalise(fit: DataFrame, centre: Centre, d: int, steps: int | None = None, seed: int = 7) -> Bidiagonal:
    """Golub-Kahan-Lanczos steps until the row space is used up, or `steps` of them.

    Both sides are fully reorthogonalised. Where the recurrence ends early (fewer dimensions, or eigenvalues
    that repeat) it goes on from a fresh vector, until that one finds nothing either.
    """
    rng, found = np.random.default_rng(seed), Bidiagonal()
    v, restarted, scale = found.fresh(rng, d), True, 0.0
    while len(found.v) < (d if steps is None else min(d, steps)):
        k = len(found.v)
        w = v if restarted or not k else v - found.beta[-1] * found.w[-1]
        earlier = np.array([*found.w, w]).T

        def part(x: np.ndarray, k: int = k, earlier: np.ndarray = earlier) -> np.ndarray:
            a = centre.centred(x)
            left = a @ earlier
            p = left[:, k]
            return np.concatenate([[p @ p], left[:, :k].T @ p, a.T @ p])

        sums = _totals(fit, d, 1 + k + d, part)
        along, back = sums[1 : 1 + k], sums[1 + k :]
        if k:
            w = w - np.array(found.w).T @ along
            back = back - np.array(found.back).T @ along
        alpha = float(np.sqrt(max(sums[0] - along @ along, 0.0)))
        scale = max(scale, alpha, *found.beta, 0.0)
        if alpha <= NOTHING * scale:
            if restarted:
                break
            alpha, w, back = 0.0, np.zeros(d), np.zeros(d)
        else:
            w, back = w / alpha, back / alpha
        found.v.append(v)
        found.w.append(w)
        found.back.append(back)
        found.alpha.append(alpha)
        onward = _clear(back, found.v)
        beta = float(np.linalg.norm(onward))
        restarted = beta <= NOTHING * scale
        found.beta.append(0.0 if restarted else beta)
        if len(found.v) < d:
            v = found.fresh(rng, d) if restarted else onward / beta
    return found


def fit_whitening(fit: DataFrame, d: int, components: int = 16, steps: int | None = None) -> Whitening:
    """Leading components of distinct whole vectors `x` of length d.

    Fewer than `components` come back where fewer eigenvalues are above zero. By default there are as many
    passes over the rows as dimensions, and every eigenvalue is found; `steps` ends wide fits earlier.
    """
    centre = centre_of(fit, d) if d else Centre(0, np.zeros(0, np.int64), np.zeros(0, np.int64))
    found = bidiagonalise(fit, centre, d, steps) if centre.n > 1 else Bidiagonal()
    if not found.v:
        return Whitening(centre, np.zeros((d, 0)), np.zeros(0), 0.0)
    _, singular, right = np.linalg.svd(found.matrix())
    kept = min(components, int((singular > NOTHING * singular[0]).sum()))
    columns = (np.array(found.v).T @ right.T)[:, :kept]
    trace = _totals(fit, d, 1, lambda x: np.array([(centre.centred(x) ** 2).sum()]))[0] / centre.n
    return Whitening(centre, columns / np.linalg.norm(columns, axis=0), singular[:kept] ** 2 / centre.n, float(trace))


def identity_error(fit: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    k, n = len(model.values), model.centre.n
    if not k:
        return 0.0

    def part(x: np.ndarray) -> np.ndarray:
        z = model.apply(x)
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    sums = _totals(fit, d, k + k * k, part)
    mean = sums[:k] / n
    return float(np.abs(sums[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())


def whiten(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = 16) -> DataFrame:
    """RESULT: a row for each vector and component, repeated rows and ids included.

    Vectors that are null or empty, hold null or non-finite entries (or beyond LARGEST), or have another
    length than most take no part. Equal vectors count once in the fit. Other columns are ignored. No
    rows come back where no direction has a spread: an empty table, one vector, or copies of one.
    """
    numbered = stage(whole_vectors(rows, vec_id, vector), "vectors")
    kept, d = one_length(numbered)
    fit = stage(kept.select("x").distinct(), "fit")
    model = fit_whitening(fit, d, components)
    error, explained = identity_error(fit, d, model), model.values / model.trace if len(model.values) else model.values
    k = len(model.values)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch, d)
            at = pa.array(np.repeat(np.arange(len(x)), k))
            deviation = pa.array(model.centre.deviation(x), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(at), model.centre.n, np.int64)),
                    deviation.take(at),
                    pa.array(model.apply(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(at), error)),
                ],
                [column.split()[0] for column in RESULT.split(", ")],
            )

    return kept.mapInArrow(run, RESULT)
