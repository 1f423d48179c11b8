import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import whitening

TABLE = "vec_id long, embedding array<float>, label int, x string, id string, whitened double"


def brute(rows):
    """Exact means and covariances over distinct vectors with fractions; then eigh."""
    used = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in used})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    cov = np.array([[float(sum((Fraction(x[i]) - Fraction(sums[i], n)) * (Fraction(x[j]) - Fraction(sums[j], n)) for x in fit) / n)
                     for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    return used, n, sums, cov, values[::-1], vectors[:, ::-1]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", "id", 0.5) for i, v in rows], TABLE).repartition(3)


@pytest.mark.parametrize("d", [1, 3, 6])
def test_whitening_equals_brute_force(spark, d):
    rng = random.Random(d)
    rows = [(i, [rng.gauss(0.3 * k, 0.1 + 0.2 * k) for k in range(d)]) for i in range(150)]
    rows += [(200, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (201, [c + 1e-6 for c in rows[2][1]])]
    odd = [(300, None), (301, [None] * d), (302, [float("nan")] * d), (303, [float("inf")] + [0.0] * (d - 1)), (304, [0.1] * (d + 1)), (305, [])]
    used, n, sums, cov, values, vectors = brute(rows)
    got = whitening.report(frame(spark, rows + odd)).collect()
    k = min(4, d)
    assert len(got) == len(rows) * k and {r["n"] for r in got} == {n}
    deviation = sorted(sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in used)
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == deviation
    for c in range(k):
        mine = [r for r in got if r["component"] == c + 1]
        want = {}
        for i, x in used:
            want.setdefault(i, []).append(sum((v - s / n) * a for v, s, a in zip(x, sums, vectors[:, c])) / math.sqrt(values[c]))
        first = next(r for r in mine if r["vec_id"] == 7)
        sign = math.copysign(1, first["whitened"] * want[7][0])
        for i, vs in want.items():
            assert sorted(r["whitened"] * sign for r in mine if r["vec_id"] == i) == pytest.approx(sorted(vs), abs=1e-8)
        assert mine[0]["explained"] == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    assert {r["identity_error"] for r in got} == {got[0]["identity_error"]} and got[0]["identity_error"] < 1e-9


def test_exact_sums_of_large_numbers():
    rng = np.random.default_rng(3)
    for top in (100, 1 << 29, 1 << 40, 1 << 61):
        y = rng.integers(-top, top, (50, 3))
        want = [sum(int(r[i]) ** 2 if i == j else (int(r[i]) + int(r[j])) ** 2 for r in y) for i in range(3) for j in range(i, 3)]
        assert whitening.pair_squares(whitening._less(y, [0, 0, 0])) == want
        assert whitening._column_sums(y) == [sum(map(int, y[:, k])) for k in range(3)]
    for v in (0, 1, -1, -(1 << 130) + 5, 1 << 150):
        a, b, c = ([*x][0] for x in whitening._limbs([v]))
        assert a + (b << 60) + (c << 120) == v


def test_large_entries_and_no_variance(spark):
    big = whitening.report(frame(spark, [(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [5.0, 2.0])])).collect()
    assert len(big) == 6 and all(r["deviation"] is None for r in big if r["vec_id"] < 3)
    assert all(math.isfinite(r["whitened"]) for r in big if r["component"] == 1)
    one = whitening.report(frame(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    flat = whitening.report(frame(spark, [(i, [i / 256, 2 * i / 256]) for i in range(9)])).collect()  # one direction only
    assert {r["whitened"] is None for r in flat if r["component"] == 2} == {True}
    assert flat[0]["identity_error"] < 1e-9
    assert whitening.report(frame(spark, [])).count() == 0
    assert whitening.report(frame(spark, [(1, None)])).count() == 0


def test_hot_vector_counts_once(spark):
    rows = frame(spark, [(i, [0.1 * (i % 4 == 0), 0.2 * (i % 8 == 0), 0.01 * (i % 3)]) for i in range(600)])
    got = whitening.report(rows)
    assert got.count() == 1800
    assert got.select("n").distinct().first()[0] == rows.select(F.transform("embedding", lambda c: F.floor(c.cast("double") * 256))).distinct().count()
