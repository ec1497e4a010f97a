"""The density by a spline against B-splines on the same knots."""

import numpy as np
import pytest

from fcbias.operators import aggregates as A


def b_spline_matrix(knots, at, n):
    """Values of the n cubic B-splines at some places (Cox and de Boor)."""
    at = np.asarray(at, float)
    last = np.searchsorted(knots, at, "right") - 1
    last = np.clip(last, 3, n - 1)
    value = np.zeros((len(at), len(knots) - 1))
    value[np.arange(len(at)), last] = 1.0
    for degree in range(1, 4):
        raised = np.zeros_like(value)
        for i in range(len(knots) - 1 - degree):
            left, right = knots[i + degree] - knots[i], knots[i + degree + 1] - knots[i + 1]
            if left > 0:
                raised[:, i] += (at - knots[i]) / left * value[:, i]
            if right > 0:
                raised[:, i] += (knots[i + degree + 1] - at) / right * value[:, i + 1]
        value = raised
    return value[:, :n]


def interpolated(centres_x, centres_y, values, x, y):
    """Interpolating bicubic spline; the knots leave out the second centre and the last but one."""
    def knots(c):
        return np.concatenate([[c[0]] * 4, c[2:-2], [c[-1]] * 4])

    kx, ky, n = knots(centres_x), knots(centres_y), len(centres_x)
    coefficients = np.linalg.solve(b_spline_matrix(kx, centres_x, n), values)
    coefficients = np.linalg.solve(b_spline_matrix(ky, centres_y, n), coefficients.T).T
    out = np.einsum("pk,kl,pl->p", b_spline_matrix(kx, x, n), coefficients, b_spline_matrix(ky, y, n))
    inside = (x >= centres_x[0]) & (x <= centres_x[-1]) & (y >= centres_y[0]) & (y <= centres_y[-1])
    return np.where(inside, out, 0.0)


@pytest.mark.parametrize("bins", [4, 7, 60])
def test_density_equals_b_splines(spark, bins):
    rng = np.random.default_rng(bins)
    x, y = rng.normal(3, 2, 900), rng.normal(-1, 5, 900)
    points = spark.createDataFrame([(int(i), float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))] + [(900, None, 1.0)], "id long, x double, y double")
    histogram, ex, ey = np.histogram2d(x, y, bins=bins, density=True)
    want = interpolated((ex[1:] + ex[:-1]) / 2, (ey[1:] + ey[:-1]) / 2, histogram, x, y)
    rows = A.density_by_spline(points, "x", "y", bins).collect()
    got = np.array([r.density for r in sorted(rows, key=lambda r: r.id)])
    assert [r.id for r in sorted(rows, key=lambda r: r.id)] == list(range(900))
    assert np.allclose(got, want, atol=1e-12 + 1e-9 * histogram.max())
    assert (want == 0).sum() > 0 and (want > 0).sum() > 100


def test_cubics_are_reproduced():
    """The pieces through values of a cubic are that cubic."""
    at = np.arange(9.0)
    cubic = lambda t: 2 * t**3 - 5 * t**2 + 3 * t - 7
    pieces = A.spline_pieces(9) @ cubic(at)
    for i, terms in enumerate(pieces):
        offset = np.linspace(0, 1, 5)
        assert np.allclose(sum(c * offset**p for p, c in enumerate(terms)), cubic(i + offset))


def test_number_of_bins_is_bounded(spark):
    points = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    assert [r.density for r in A.density_by_spline(points, "x", "y", 8).collect()] == [r.density for r in A.density_by_spline(points, "x", "y", 8).collect()]
    for bins in (3, 201):
        with pytest.raises(ValueError):
            A.density_by_spline(points, "x", "y", bins)
