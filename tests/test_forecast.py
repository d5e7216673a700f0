import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from finseries.functions import trend_model
from finseries.operators import forecast as FC
from finseries.plans import catalogue


def _series(spark, sym, n, fn, start=dt.date(2024, 1, 1)):
    rows = [(sym, start + dt.timedelta(days=i), float(fn(i))) for i in range(n)]
    return spark.createDataFrame(rows, "symbol string, date date, close double")


def test_gate_29_and_30_points(spark):
    df = _series(spark, "S29", 29, lambda i: 10 + i).unionByName(_series(spark, "S30", 30, lambda i: 10 + i))
    tr = FC.training_set(df)
    assert {r.symbol for r in tr.select("symbol").distinct().collect()} == {"S30"}
    fc = FC.forecast_baseline(tr, horizon=5)
    assert fc.count() == 5


def test_last_120_and_daily_mean(spark):
    df = _series(spark, "A", 200, lambda i: 100 + i)
    dup = _series(spark, "A", 1, lambda i: 300.0, start=dt.date(2024, 1, 1) + dt.timedelta(days=199))
    tr = FC.training_set(df.unionByName(dup)).collect()
    assert len(tr) == 120
    last = max(tr, key=lambda r: r.ds)
    assert abs(math.exp(last.y) - (299 + 300) / 2) < 1e-9


def test_non_positive_prices_are_left_out(spark):
    df = _series(spark, "A", 40, lambda i: 0.0 if i == 39 else 5.0)
    tr = FC.training_set(df).collect()
    assert len(tr) == 39 and all(r.y is not None for r in tr)


def test_baseline_constant_series_forecasts_itself(spark):
    tr = FC.training_set(_series(spark, "C", 60, lambda i: 42.0))
    got = [r.forecast for r in FC.forecast_baseline(tr, horizon=7).collect()]
    assert len(got) == 7 and all(abs(v - 42.0) < 1e-9 for v in got)


def test_baseline_scales_with_price(spark):
    f = lambda i: 10 * math.exp(0.01 * i) * (1.1 if i % 7 == 3 else 1.0)
    a = FC.forecast_baseline(FC.training_set(_series(spark, "A", 90, f)), horizon=10)
    b = FC.forecast_baseline(FC.training_set(_series(spark, "A", 90, lambda i: 3 * f(i))), horizon=10)
    ja = {r.date: r.forecast for r in a.collect()}
    jb = {r.date: r.forecast for r in b.collect()}
    assert ja.keys() == jb.keys() and all(abs(jb[d] / ja[d] - 3) < 1e-9 for d in ja)


def test_combined_rows_and_types(spark):
    tr = FC.training_set(_series(spark, "A", 50, lambda i: 10 + math.sin(i)))
    fc = FC.forecast_baseline(tr, horizon=15, with_fitted=True)
    out = FC.combined(tr, fc, show_last=30)
    counts = {r.Type: r["count"] for r in out.groupBy("Type").count().collect()}
    assert counts == {"Actual": 30, "Fitted": 50, "Forecast": 15}
    band = FC.band(out).collect()
    assert len(band) == 15 and all(r.lower_ci <= r.value <= r.upper_ci for r in band)


def test_additive_model_constant_and_bounds(spark):
    tr = FC.training_set(_series(spark, "C", 60, lambda i: 42.0))
    out = FC.forecast_additive(tr, horizon=10).collect()
    assert len(out) == 70
    assert all(abs(r.value - 42.0) / 42.0 < 1e-3 for r in out)
    assert all(r.lower_ci <= r.value <= r.upper_ci for r in out)


def test_additive_model_follows_trend_and_widens(spark):
    tr = FC.training_set(_series(spark, "T", 120, lambda i: 20 * math.exp(0.004 * i)))
    out = FC.forecast_additive(tr, horizon=30).where(F.col("Type") == "Forecast").orderBy("date").collect()
    assert len(out) == 30
    assert out[-1].value > out[0].value > 20 * math.exp(0.004 * 119) * 0.98
    width = [r.upper_ci - r.lower_ci for r in out]
    assert width[-1] >= width[0]


def test_trend_model_is_deterministic():
    ds = np.arange(np.datetime64("2024-01-01"), np.datetime64("2024-04-01"))
    y = np.log(50 + np.sin(np.arange(len(ds)) / 3.0))
    a, b = trend_model.fit(ds, y), trend_model.fit(ds, y)
    assert np.array_equal(a.theta, b.theta) and a.sigma == b.sigma


def test_trend_model_follows_a_slope_change():
    ds = np.arange(np.datetime64("2024-01-01"), np.datetime64("2024-05-01"))
    t = np.arange(len(ds)) / (len(ds) - 1)
    y = np.where(t < 0.5, 1.0 + 0.2 * t, 1.1 + 1.0 * (t - 0.5))
    m = trend_model.fit(ds, y)
    mean, lo, hi = trend_model.predict(m, ds)
    assert np.max(np.abs(mean - y)) < 0.02
    assert np.all(lo <= mean) and np.all(mean <= hi)


def test_package_is_shipped_to_workers(spark):
    from finseries.session import ship_package
    ship_package(spark)
    includes = [p for p in spark.sparkContext._python_includes if "finseries-" in p and p.endswith(".zip")]
    assert includes


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=30, deadline=None)
@given(st.integers(30, 120), st.integers(0, 10_000), st.floats(0.001, 0.1))
def test_trend_model_properties(n, seed, vol):
    rng = np.random.default_rng(seed)
    ds = np.arange(np.datetime64("2023-03-01"), np.datetime64("2023-03-01") + n)
    y = 3.0 + np.cumsum(rng.normal(0, vol, n))
    m = trend_model.fit(ds, y)
    future = ds[-1] + np.arange(1, 16).astype("timedelta64[D]")
    mean, lo, hi = trend_model.predict(m, np.concatenate([ds, future]))
    assert np.all(np.isfinite(mean)) and np.all(lo <= mean) and np.all(mean <= hi)
    width = hi - lo
    assert np.all(np.diff(width[n:]) >= -1e-9)  # intervals do not narrow past the data
    # the fit stays near the data it was given (priors only pull slightly)
    assert np.sqrt(np.mean((mean[:n] - y) ** 2)) < 4 * vol * np.sqrt(n) + 1e-6


def test_trend_model_meets_its_optimality_conditions():
    rng = np.random.default_rng(3)
    for _ in range(25):
        n = int(rng.integers(1, 121))
        ds = np.datetime64("2020-01-01") + np.sort(rng.choice(400, n, replace=False))
        y = 5 + np.cumsum(rng.normal(0, rng.choice([0, 0.001, 0.05, 0.5]), n))
        assert trend_model.fit(ds, y).converged


def test_sparse_ridge_against_coordinate_descent():
    rng = np.random.default_rng(4)
    for _ in range(20):
        p = 6
        m = rng.normal(size=(12, p))
        A, b = m.T @ m + 0.1 * np.eye(p), rng.normal(size=p) * 5
        l1 = np.where(np.arange(p) < 2, 0.0, 2.0)
        x = np.zeros(p)
        for _ in range(5000):
            for i in range(p):
                r = b[i] - A[i] @ x + A[i, i] * x[i]
                x[i] = np.sign(r) * max(abs(r) - l1[i], 0.0) / A[i, i]
        assert np.allclose(trend_model._sparse_ridge(A, b, l1, np.zeros(p)), x, atol=1e-8)


def test_nan_prices_are_left_out(spark):
    from finseries.operators import forecast as FC
    rows = [("A", f"2024-01-{d:02d}", float("nan") if d == 5 else float(d)) for d in range(1, 32)]
    df = spark.createDataFrame(rows, "symbol string, date string, close double").selectExpr("symbol", "CAST(date AS DATE) AS date", "close")
    tr = FC.training_set(df, "symbol", 30, 120)
    assert tr.count() == 30 and tr.where("isnan(y)").count() == 0


def _outside(monkeypatch):
    """Every forecast row is lifted above its band."""
    model = FC.forecast_additive

    def lifted(train, k, horizon):
        over = F.when(F.col("Type") == "Forecast", F.col("upper_ci") * 2).otherwise(F.col("value"))
        return model(train, k, horizon).withColumn("value", over)

    monkeypatch.setattr(FC, "forecast_additive", lifted)


def _in_band(df):
    return {(r.Type, r.in_band) for r in df.select("Type", "in_band").distinct().collect()}


GOOD = {("Actual", None), ("Fitted", True), ("Forecast", True)}
BAD = {("Actual", None), ("Fitted", True), ("Forecast", False)}


def test_forecast_additive_judges_each_model_row_by_its_band(spark, monkeypatch):
    own = _series(spark, "A", 40, lambda i: 10 + math.sin(i)).unionByName(_series(spark, "B", 35, lambda i: 20 + i % 3))
    monkeypatch.setattr(catalogue.A, "tick_bars", lambda *_: own)
    assert _in_band(catalogue.forecast_additive(spark, "")) == GOOD
    _outside(monkeypatch)
    assert _in_band(catalogue.forecast_additive(spark, "")) == BAD


def test_stock_forecast_judges_each_model_row_by_its_band(spark, monkeypatch):
    own = _series(spark, "A", 40, lambda i: 10 + math.sin(i)).unionByName(_series(spark, "B", 35, lambda i: 20 + i % 3))
    monkeypatch.setattr(catalogue.A, "long_bars", lambda *_: own.withColumnRenamed("symbol", "stock"))
    assert _in_band(catalogue.stock_forecast(spark, "")) == GOOD
    _outside(monkeypatch)
    assert _in_band(catalogue.stock_forecast(spark, "")) == BAD
