"""Certificates of linear fits: optimality conditions and coefficients in original units."""

import numpy as np
import pytest

from tessera.operators import models as ML


def test_optimality_of_a_logistic_fit(spark):
    """Zero at the minimum found by plain gradient steps, large elsewhere; an L1 weight at zero may have a gradient within the penalty."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2))
    y = (rng.random(300) < 1 / (1 + np.exp(-(1.5 * x[:, 0] + 0.2)))).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    residual = lambda w, b, **o: ML.logistic_optimality(df, ["a", "b"], "y", list(w), b, **o).first()[0]
    for ridge, lasso in ((0.0, 0.0), (0.1, 0.0), (0.0, 0.15)):
        w, b = np.zeros(2), 0.0
        for _ in range(4000):
            off = 1 / (1 + np.exp(-(x @ w + b))) - y
            w = w - 0.5 * (x.T @ off / 300 + ridge * w)
            w = np.sign(w) * np.maximum(np.abs(w) - 0.5 * lasso, 0.0)
            b -= 0.5 * off.mean()
        assert residual(w, b, ridge=ridge, lasso=lasso) < 1e-9
        assert residual(w + np.array([0.3, 0.0]), b, ridge=ridge, lasso=lasso) > 1e-3
        assert (w[1] == 0) == (lasso > 0)


def test_original_units():
    own, start = ML.original_units([2.0, -3.0, 1.0], 0.5, [10.0, 4.0, 7.0], [4.0, 0.5, 0.0])
    assert own == [0.5, -6.0, 0.0] and start == pytest.approx(0.5 - 0.5 * 10 + 6 * 4)
