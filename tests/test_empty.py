"""Empty inputs give empty results, never errors."""

from finseries.operators import forecast as FC
from finseries.operators import indicators as I
from finseries.operators import snapshot as S
from finseries.operators import trends as T

from conftest import BAR_SCHEMA


def test_empty_inputs(spark):
    bars = spark.createDataFrame([], BAR_SCHEMA)
    ind = spark.createDataFrame([], "indicator string, date date, value double")
    assert S.snapshot_change(bars, "symbol", "name").count() == 0
    assert S.sparkline(bars, "symbol", "name").count() == 0
    assert T.history(bars, "symbol").count() == 0
    assert T.open_close(bars, "symbol", "name").count() == 0
    assert I.rolling_mean(ind).count() == 0
    tr = FC.training_set(bars)
    assert tr.count() == 0
    assert FC.forecast_baseline(tr, with_fitted=True).count() == 0
    assert FC.forecast_additive(tr).count() == 0
    row = S.latest_dates(bars).first()
    assert row.latest is None and row.prev is None
