"""Trends whose slope changes, against dense linear algebra."""

import numpy as np
import pytest

from filmdw.operators.forecast import changepoint_forecast, trend_forecast

COLUMNS = ["year", "predicted_revenue_B", "lower_bound_B", "upper_bound_B"]


def plain(years, y, count, last_year=2024, horizon=5):
    t = (years - years.min()) / (years.max() - years.min())
    places = np.array([0.8 * j / count for j in range(1, count + 1)])
    basis = lambda t: np.column_stack([np.ones_like(t), t, *[np.maximum(t - s, 0) for s in places]])
    x = basis(t)
    inverse = np.linalg.inv(x.T @ x + np.diag([0, 0] + [(0.1 / 0.3) ** 2] * count))
    weights = inverse @ x.T @ y
    noise = ((y - x @ weights) ** 2).sum() / (len(y) - np.trace(inverse @ x.T @ x))
    future = np.arange(last_year + 1, last_year + 1 + horizon)
    t0 = (future - years.min()) / (years.max() - years.min())
    at = basis(t0)
    to_come = (weights[2:] ** 2).sum() / 0.8
    half = 1.959963984540054 * np.sqrt(
        noise * (1 + np.einsum("ij,jk,ik->i", at, inverse, at)) + to_come * (t0 - 1) ** 3 / 3
    )
    return np.column_stack([future, at @ weights, at @ weights - half, at @ weights + half])


def bent(seed: int):
    years = np.arange(1980, 2025)
    slope = np.where(years < 2000, 0.4, 1.5)
    return years, np.cumsum(slope) + np.random.default_rng(seed).normal(0, 0.3, len(years))


def frame(spark, groups):
    rows = [(name, int(a), float(b)) for name, (years, y) in groups.items() for a, b in zip(years, y)]
    return spark.createDataFrame(rows, "g string, year int, y double").repartition(5)


@pytest.mark.parametrize("count", [1, 3, 8])
def test_groups_equal_dense_algebra(spark, count):
    groups = {"a": bent(1), "b": bent(2), "c": (np.array([1990, 1995, 1996, 2001]), np.array([1.0, 3, 2, 8]))}
    found = changepoint_forecast(frame(spark, groups), ["g"], changepoints=count).orderBy("g", "year").collect()
    for name, (years, y) in groups.items():
        rows = np.array([[r[c] if r[c] is not None else np.nan for c in COLUMNS] for r in found if r["g"] == name])
        want = plain(years, y, count)
        known = ~np.isnan(rows)
        assert known[:, :2].all() and (known.all() or name == "c")
        assert np.allclose(rows[known], want[known], rtol=1e-8)


def test_the_late_slope_is_followed(spark):
    years, y = bent(3)
    series = frame(spark, {"a": (years, y)})
    truth = y[-1] + 1.5 * 5
    straight = trend_forecast(series).where("year = 2029").first()["predicted_revenue_B"]
    bending = changepoint_forecast(series).where("year = 2029").first()["predicted_revenue_B"]
    assert abs(bending - truth) < 3 < abs(straight - truth)


def test_without_changepoints_it_is_a_line(spark):
    series = frame(spark, {"a": bent(1), "b": bent(2)})
    line = sorted(map(tuple, trend_forecast(series, ["g"]).collect()))
    found = sorted(map(tuple, changepoint_forecast(series, ["g"], changepoints=0).collect()))
    assert [r[:2] for r in line] == [r[:2] for r in found]
    assert np.allclose([r[2:] for r in line], [r[2:] for r in found])


def test_short_series(spark):
    series = frame(spark, {"one": ([2000], [1.0]), "two": ([2000, 2001], [1.0, 2.0])})
    rows = changepoint_forecast(series, ["g"], changepoints=0).orderBy("g", "year").collect()
    assert rows[0]["predicted_revenue_B"] is None and abs(rows[5]["predicted_revenue_B"] - 26) < 1e-9
    assert all(r["lower_bound_B"] is None for r in rows)
    assert changepoint_forecast(series.where("year < 0"), ["g"]).count() == 0
    assert changepoint_forecast(series.where("year < 0")).count() == 0
