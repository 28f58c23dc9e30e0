"""Whitening against dense linear algebra on whole small tables."""

import math
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import queries, whitening

DATA = Path("/root/testdata/sf0.01")


def by_hand(rows, k=16):
    """{(vec_id, row number): ...} of kept rows, from the exact covariance."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for _, v in kept]
    fit = sorted(set(map(tuple, x)))
    n, d = len(fit), len(fit[0])
    sums = [sum(v[j] for v in fit) for j in range(d)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in fit])
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = [
        (i, sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)), np.array([(n * a - s) / n for a, s in zip(v, sums, strict=True)]) @ vectors)
        for (i, _), v in zip(kept, x, strict=True)
    ]
    return n, values, np.trace(covariance), out


def compare(got, rows, k=16):
    n, values, trace, want = by_hand(rows, k)
    assert len(got) == k * len(want)
    assert {r["n"] for r in got} == {n}
    (error,) = {r["identity_error"] for r in got}
    assert 0 <= error < 1e-9
    explained = {r["component"]: r["explained"] for r in got}
    assert np.allclose([explained[c] for c in range(1, k + 1)], values / trace, rtol=1e-10)
    table = {}
    for r in got:
        table.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r["whitened"])
    signs = np.zeros(k)
    for vec_id, deviation, projected in want:
        mine = np.array([table[(vec_id, deviation)][c][0] for c in range(1, k + 1)])
        theirs = projected / np.sqrt(values)
        sure = np.abs(theirs) > 1e-3
        signs[sure & (signs == 0)] = np.sign(theirs * mine)[sure & (signs == 0)]
        assert np.allclose(mine * np.where(signs == 0, 1, signs), theirs, atol=1e-8)


@pytest.mark.skipif(not DATA.exists(), reason="driver tables not present")
def test_query_equals_dense_algebra_on_the_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(queries.op11_embedding_whitening(spark, str(DATA)).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(k, [float(c) for c in rng.standard_normal(6) * (1, 2, 3, 4, 5, 6)]) for k in range(80)]
    rows += [(1, rows[1][1]), (1, rows[1][1]), (None, rows[2][1]), (200, rows[3][1])]
    odd = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (93, [math.nan] * 6), (94, [math.inf] * 6), (95, [1.0] * 5)]
    table = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").withColumn("x", F.lit("clash")).withColumn("n", F.lit(0))
    compare(whitening.whiten(table, components=6).collect(), rows, 6)
    for none in (table.limit(0), table.where("vec_id = 90"), table.where("vec_id = 5"), table.where("vec_id = 1")):
        assert whitening.whiten(none).count() == 0


def test_fewer_dimensions_and_repeated_values(spark):
    rng = np.random.default_rng(4)
    flat = rng.integers(-9, 9, (120, 3)) @ rng.integers(-3, 3, (3, 8))
    got = whitening.whiten(spark.createDataFrame([(k, [float(c) for c in v]) for k, v in enumerate(flat)], "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1, 2, 3} and got[0]["identity_error"] < 1e-9
    # A cross: all eigenvalues are the same, so each step starts afresh.
    cross = [[float(s * (j == k)) for j in range(5)] for k in range(5) for s in (-1, 1)]
    got = whitening.whiten(spark.createDataFrame(list(enumerate(cross)), "vec_id long, embedding array<double>")).collect()
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5} and got[0]["identity_error"] < 1e-9
    assert np.allclose([r["explained"] for r in got], 0.2)


def test_deviation_is_exact_beyond_64_bits():
    centre = whitening.Centre(3, np.array([10, -5]), np.array([1, 2]))
    x = np.array([[2**40, -(2**41)], [10, -5]])
    want = [sum((3 * int(a) - (3 * m + r)) ** 2 for a, m, r in zip(v, (10, -5), (1, 2), strict=True)) for v in x]
    assert want[0] > 2**63 and centre.deviation(x) == [None, want[1]]
    near = np.array([[2**28, 7]])
    assert centre.deviation(near) == [(3 * 2**28 - 31) ** 2 + (21 + 13) ** 2]
