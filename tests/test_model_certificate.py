"""The fit's certificate and Newton polish against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from splitsafe.operators import model


def brute(x, y, w, c):
    z = np.c_[np.ones(len(x)), x]
    p = 1 / (1 + np.exp(-z @ w))
    ridge = np.diag(np.r_[0.0, np.full(x.shape[1], 1 / c)])
    return z.T @ (p - y) + ridge @ w, (z * (p * (1 - p))[:, None]).T @ z + ridge


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 3))
    y = (rng.random(500) < 1 / (1 + np.exp(-(x @ [2.0, -1.0, 0.0] - 1)))).astype(int)
    rows = [(*map(float, a), int(b)) for a, b in zip(x, y)]
    return x, y, spark.createDataFrame(rows, "a double, b double, c double, y int")


def test_certificate_is_gradient_and_hessian(data):
    x, y, df = data
    w = np.array([0.3, -0.2, 0.5, 1.0])
    n, g, h = model.certificate(df, ["a", "b", "c"], "y", w, 0.1)
    want_g, want_h = brute(x, y, w, 0.1)
    assert n == 500 and np.allclose(g, want_g) and np.allclose(h, want_h)
    assert model.certificate(df, ["a", "b", "c"], "y", w, 0.1, hessian=False)[2] is None


@pytest.mark.parametrize("start", [np.zeros(4), np.array([5.0, -9.0, 9.0, 4.0])])
def test_polish_ends_at_the_minimum(data, start):
    x, y, df = data
    w = model.polish(df, ["a", "b", "c"], "y", start, 0.1)
    assert np.abs(brute(x, y, w, 0.1)[0]).max() < 1e-7


def test_report_and_degenerate_fits(spark, data):
    _, _, df = data
    got = model.fit_report(df.withColumn("flat", F.lit(1.0)).withColumn("void", F.lit(None).cast("double")), ["a", "b", "flat", "void"], "y").collect()
    assert [r["parameter"] for r in got] == ["intercept", "a", "b", "flat"]
    assert all(abs(r["gradient"]) < 1e-9 for r in got) and got[3]["weight"] == pytest.approx(0, abs=1e-9)
