"""Short-horizon price forecasts for every asset at once.

``training_set`` reduces each asset to at most ``last`` daily log prices.
``forecast_baseline`` is pure Spark SQL (log-linear trend plus a weekday
mean residual); ``forecast_additive`` fits the trend-plus-weekly-cycle model
in one grouped-map task per asset.  Both return fitted rows over the
training dates and forecast rows for ``horizon`` calendar days after the
last one; ``combined`` adds the recent actuals in the same long form.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finseries.functions import trend_model
from finseries.functions.parse import numbers
from finseries.schemas import DEFAULT_HORIZON, DEFAULT_SHOW_LAST, MAX_TRAIN_POINTS, MIN_TRAIN_POINTS
from finseries.session import ship_package

ACTUAL, FITTED, FORECAST = "Actual", "Fitted", "Forecast"
Z80 = trend_model.INTERVAL_Z


def _last_n(df: DataFrame, key: str, date_col: str, n: int) -> DataFrame:
    """The ``n`` latest rows per key.

    ``row_number() <= n`` is planned as a WindowGroupLimit before and after the
    shuffle, so each task sends at most ``n`` rows per key: a dominant key
    cannot flood one task.
    """
    w = Window.partitionBy(key).orderBy(F.col(date_col).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def training_set(bars: DataFrame, key: str = "symbol", min_points: int = MIN_TRAIN_POINTS,
                 last: int = MAX_TRAIN_POINTS, date_col: str = "date",
                 price_col: str = "close") -> DataFrame:
    """Per asset: mean price per date, only assets with ``min_points`` dates,
    the latest ``last`` dates, natural log.  Output: key, ds, y.

    Non-positive prices have no logarithm and are left out after the cut.
    When several forecasts or the combined output read the result, write it
    once with ``store.stage`` so the bar table is not scanned per branch.
    """
    daily = (numbers(bars.select(key, date_col, price_col))
             .where(F.col(date_col).isNotNull() & F.col(price_col).isNotNull())
             .groupBy(key, date_col).agg(F.avg(price_col).alias("_p")))
    counts = daily.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    enough = counts.where(F.col("_n") >= min_points).select(key)
    recent = _last_n(daily, key, date_col, last).join(enough, key, "left_semi")
    return recent.where(F.col("_p") > 0).select(
        key, F.col(date_col).alias("ds"), F.ln("_p").alias("y"))


def future_dates(last_ds, horizon: int):
    """Column of the ``horizon`` calendar days after ``last_ds`` (for explode)."""
    return F.sequence(F.date_add(last_ds, 1), F.date_add(last_ds, horizon))


def _keys(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def forecast_baseline(train: DataFrame, key: str | list[str] = "symbol", horizon: int = DEFAULT_HORIZON,
                      with_fitted: bool = False, digits: int | None = None, with_bounds: bool = False) -> DataFrame:
    """Log-linear trend plus weekday mean residual, back-transformed.

    Per asset: intercept ``a`` and slope ``b`` of y on x (days since the
    asset's last training date), the mean residual per weekday, and the
    sample sd of the remaining residuals for 80 % bounds.  Output: key, date,
    forecast (future days only), or with ``with_fitted`` key, date, value,
    Type, lower_ci, upper_ci for training and future days (``with_bounds``: the same for future days only).

    ``train`` holds at most a fixed number of rows per asset (the training
    cut), so windows partitioned by the asset are bounded; they replace the
    aggregate-and-join passes.  The per-asset weekday means (at most seven)
    travel to the future rows as a small map.
    """
    keys = _keys(key)
    asset = Window.partitionBy(*keys)
    day = Window.partitionBy(*keys, "_dow")
    h = (train.select(*keys, "ds", "y")
         .withColumn("last_ds", F.max("ds").over(asset))
         .withColumn("x", F.datediff("ds", "last_ds").cast("double"))
         .withColumn("a", F.regr_intercept("y", "x").over(asset))
         .withColumn("b", F.regr_slope("y", "x").over(asset))
         .withColumn("_dow", F.dayofweek("ds"))
         .withColumn("_s", F.avg(F.col("y") - (F.col("a") + F.col("b") * F.col("x"))).over(day))
         .withColumn("_pred", F.col("a") + F.col("b") * F.col("x") + F.col("_s")))
    per = h.groupBy(*keys).agg(
        F.max("last_ds").alias("last_ds"), F.max("a").alias("a"), F.max("b").alias("b"),
        F.map_from_entries(F.collect_set(F.struct("_dow", "_s"))).alias("_smap"),
        F.stddev_samp(F.col("y") - F.col("_pred")).alias("_sd"))
    fut = (per.select(*keys, "last_ds", "a", "b", "_smap", "_sd",
                      F.explode(future_dates(F.col("last_ds"), horizon)).alias("date"))
           .withColumn("x", F.datediff("date", "last_ds").cast("double"))
           .withColumn("_pred", F.col("a") + F.col("b") * F.col("x")
                       + F.coalesce(F.col("_smap")[F.dayofweek("date")], F.lit(0.0))))

    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    if not (with_fitted or with_bounds):
        return fut.select(*keys, "date", rnd(F.exp("_pred")).alias("forecast"))

    rows = fut.select(*keys, "date", "last_ds", "_pred", "_sd")
    if with_fitted:
        rows = h.join(per.select(*keys, "_sd"), keys).select(
            *keys, F.col("ds").alias("date"), "last_ds", "_pred", "_sd").unionByName(rows)
    sd = F.coalesce(F.col("_sd"), F.lit(0.0))
    return rows.select(
        *keys, "date",
        rnd(F.exp("_pred")).alias("value"),
        F.when(F.col("date") > F.col("last_ds"), F.lit(FORECAST)).otherwise(F.lit(FITTED)).alias("Type"),
        rnd(F.exp(F.col("_pred") - Z80 * sd)).alias("lower_ci"),
        rnd(F.exp(F.col("_pred") + Z80 * sd)).alias("upper_ci"),
    )


def actuals(train: DataFrame, key: str = "symbol", show_last: int = DEFAULT_SHOW_LAST,
            digits: int | None = None) -> DataFrame:
    """The latest ``show_last`` training rows per asset, back on the price scale."""
    rnd = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    recent = _last_n(train, key, "ds", show_last)
    return recent.select(key, F.col("ds").alias("date"), rnd(F.exp("y")).alias("value"),
                         F.lit(ACTUAL).alias("Type"),
                         F.lit(None).cast("double").alias("lower_ci"),
                         F.lit(None).cast("double").alias("upper_ci"))


def combined(train: DataFrame, fitted: DataFrame, key: str = "symbol",
             show_last: int = DEFAULT_SHOW_LAST, digits: int | None = None) -> DataFrame:
    """Actual, Fitted and Forecast rows in one long table (duplicates kept)."""
    return actuals(train, key, show_last, digits).unionByName(
        fitted.select(key, "date", "value", "Type", "lower_ci", "upper_ci"))


def band(fc: DataFrame) -> DataFrame:
    """Forecast rows only, for the interval band."""
    return fc.where(F.col("Type") == FORECAST)


def forecast_additive(train: DataFrame, key: str | list[str] = "symbol",
                      horizon: int = DEFAULT_HORIZON) -> DataFrame:
    """Trend with slope changes plus weekly cycle, one grouped-map task per asset.

    Groups are bounded by the training cut (``training_set`` keeps at most a
    fixed number of rows per asset).  Output: key, date, value, Type,
    lower_ci, upper_ci (back-transformed with ``exp`` in Spark) and converged:
    whether the asset's fit passes the optimality test of ``trend_model``.
    """
    keys = _keys(key)
    out_schema = T.StructType([
        *(T.StructField(k, train.schema[k].dataType) for k in keys), T.StructField("date", T.DateType()),
        T.StructField("last_ds", T.DateType()), T.StructField("yhat", T.DoubleType()),
        T.StructField("yhat_lower", T.DoubleType()), T.StructField("yhat_upper", T.DoubleType()),
        T.StructField("converged", T.BooleanType())])

    def fit_predict(pdf: pd.DataFrame) -> pd.DataFrame:
        ds = pd.to_datetime(pdf["ds"]).to_numpy().astype("datetime64[D]")
        y = pdf["y"].to_numpy(dtype=float)
        m = trend_model.fit(ds, y)
        last = ds.max()
        future = last + np.arange(1, horizon + 1).astype("timedelta64[D]")
        dates = np.concatenate([np.sort(ds), future])
        mean, lo, hi = trend_model.predict(m, dates)
        return pd.DataFrame({
            **{k: pdf[k].iloc[0] for k in keys}, "date": pd.to_datetime(dates).date, "last_ds": pd.Timestamp(last).date(),
            "yhat": mean, "yhat_lower": lo, "yhat_upper": hi, "converged": m.converged})

    ship_package(train.sparkSession)
    fc = train.select(*keys, "ds", "y").groupBy(*keys).applyInPandas(fit_predict, out_schema)
    return fc.select(
        *keys, "date", F.exp("yhat").alias("value"),
        F.when(F.col("date") > F.col("last_ds"), F.lit(FORECAST)).otherwise(F.lit(FITTED)).alias("Type"),
        F.exp("yhat_lower").alias("lower_ci"), F.exp("yhat_upper").alias("upper_ci"), "converged")
