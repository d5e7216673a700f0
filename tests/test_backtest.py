import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from finseries.operators import backtest as B
from finseries.operators import forecast as FC


def _series(spark, sym, days, fn, start=dt.date(2024, 1, 1)):
    rows = [(sym, start + dt.timedelta(days=i), float(fn(i))) for i in days]
    return spark.createDataFrame(rows, "symbol string, date date, close double")


def _train(spark, *series):
    df = series[0]
    for s in series[1:]:
        df = df.unionByName(s)
    return FC.training_set(df)


def test_folds_cut_at_rolling_origins(spark):
    tr = _train(spark, _series(spark, "A", range(100), lambda i: 10 + i))
    rows = B.folds(tr, n_folds=3, horizon=15).collect()
    last = dt.date(2024, 1, 1) + dt.timedelta(days=99)
    for f in (1, 2, 3):
        own = [r for r in rows if r.fold == f]
        origin = last - dt.timedelta(days=15 * f)
        assert max(r.ds for r in own if not r.held) == origin
        assert sorted(r.ds for r in own if r.held) == [origin + dt.timedelta(days=k) for k in range(1, 16)]
        assert sum(not r.held for r in own) == 100 - 15 * f


def test_short_and_gapped_assets(spark):
    gap = [i for i in range(90) if not 60 <= i <= 80]  # no bars around the second origin
    tr = _train(spark, _series(spark, "S", range(40), lambda i: 5.0), _series(spark, "G", gap, lambda i: 5.0))
    rows = B.folds(tr, n_folds=3, horizon=25).collect()
    assert {r.symbol for r in rows} == {"G"}  # S keeps fewer than 30 training days in every fold
    one = [r for r in rows if r.fold == 1]  # day 64 lies in the gap: the origin is day 59, and 81 to 84 are held out
    day = lambda r: (r.ds - dt.date(2024, 1, 1)).days
    assert max(day(r) for r in one if not r.held) == 59 and sorted(day(r) for r in one if r.held) == [81, 82, 83, 84]


def test_a_predictable_series_has_no_error_and_a_wild_one_does(spark):
    import random
    rng = random.Random(3)
    tr = _train(spark, _series(spark, "T", range(120), lambda i: 20 * math.exp(0.004 * i)), _series(spark, "W", range(120), lambda i: 50 * math.exp(rng.gauss(0, 0.3))))
    got = {r.symbol: r for r in B.backtest(tr).collect()}
    assert got["T"].n_folds == 3 and got["T"].n_held == 45
    assert got["T"].baseline_error < 1e-9 and got["T"].model_error < 0.05
    assert got["W"].baseline_error > 0.1 and 0.5 <= got["W"].baseline_inside <= 1.0 and 0.5 <= got["W"].model_inside <= 1.0


def test_a_step_outside_the_band_is_counted_as_such(spark):
    tr = _train(spark, _series(spark, "J", range(100), lambda i: (100.0 if i < 85 else 300.0) * (1 + 0.01 * math.sin(i * 1.7))))
    r = B.backtest(tr, n_folds=1).first()
    assert r.baseline_inside == 0.0 and r.model_inside == 0.0 and r.baseline_error == pytest.approx(2 / 3, abs=0.05)


def test_no_usable_fold(spark):
    tr = _train(spark, _series(spark, "S", range(30), lambda i: 5.0 + i))
    assert B.backtest(tr).count() == 0 and B.backtest(tr.where(F.lit(False))).count() == 0
