"""The smoothing spline against a dense fit with the same knots and against the curve behind the points."""

import numpy as np

from screenloom.operators import models


def made_points(spark, y):
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(y)], "rank long, log_total double").repartition(3)


def dense(t, knots):
    return np.stack([np.ones_like(t), t, t**2, t**3, *(np.maximum(t - k, 0) ** 3 for k in knots)], axis=1)


def test_residuals_are_the_number_of_points(spark):
    n = 3000
    t = np.linspace(0, 1, n)
    curve = 40 * np.tanh(30 * (t - 0.7))  # bends at 0.7 alone
    y = curve + np.random.default_rng(1).normal(0, 0.9, n)
    knots, made = models.smoothing_spline(made_points(spark, y), "rank", "log_total", n)
    assert len(knots) and abs(((dense(t, knots) @ made - y) ** 2).sum() - n) < 0.01 * n
    # knots go where the residuals are
    assert np.sum(np.abs(knots - 0.7) < 0.2) > 0.6 * len(knots) and np.min(np.diff(knots)) < 0.04
    # among the splines with these knots and residuals, it's the one with the least jumps: the dense penalised fit of equal residuals
    a, d = dense(t, knots), np.diag(np.r_[np.zeros(4), np.ones(len(knots))])
    low, high = -40.0, 40.0
    for _ in range(80):
        middle = (low + high) / 2
        c = np.linalg.lstsq(a.T @ a + np.exp(middle) * d, a.T @ y, rcond=1e-13)[0]
        low, high = (middle, high) if ((a @ c - y) ** 2).sum() < n else (low, middle)
    assert np.abs(a @ c - a @ made).max() < 0.02
    second = 2 * made[2] + 6 * made[3] * t + sum(6 * m * np.maximum(t - k, 0) for m, k in zip(made[4:], knots))
    true = np.gradient(np.gradient(curve, t), t)
    assert abs(t[second.argmin()] - t[true.argmin()]) < 0.03 and abs(t[second.argmax()] - t[true.argmax()]) < 0.03


def test_a_cubic_that_fits_has_no_knots(spark):
    t = np.linspace(0, 1, 400)
    knots, made = models.smoothing_spline(made_points(spark, 5 - 2 * t + t**3), "rank", "log_total", 400)
    assert not len(knots) and np.allclose(made, [5, -2, 0, 1], atol=1e-6)


def test_few_points_and_flat_ones(spark):
    knots, made = models.smoothing_spline(made_points(spark, [1000.0, -1000.0] * 5), "rank", "log_total", 10)
    assert not len(knots) and np.isfinite(made).all()
    knots, made = models.smoothing_spline(made_points(spark, [7.0] * 50), "rank", "log_total", 50)
    assert not len(knots) and np.allclose(made, [7, 0, 0, 0], atol=1e-6)
