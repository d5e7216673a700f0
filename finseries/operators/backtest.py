"""Rolling-origin backtest of the forecasts: what would they have said, and were they right?

From the end of each asset's training set the last ``n_folds`` stretches of
``horizon`` calendar days are held out, one fold each; every fold is a series
of its own that is fitted on the days up to its origin.  All folds of all
assets are fitted in one grouped pass, and what was forecast for the held-out
days is joined to what happened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from finseries.operators import forecast as FC
from finseries.schemas import DEFAULT_HORIZON, MIN_TRAIN_POINTS

N_FOLDS = 3


def folds(train: DataFrame, key: str = "symbol", n_folds: int = N_FOLDS, horizon: int = DEFAULT_HORIZON,
          min_points: int = MIN_TRAIN_POINTS) -> DataFrame:
    """(key, fold, ds, y, held): the training and held-out rows of every fold that has ``min_points`` of the former and any of the latter.

    Fold i's origin is the last training day at least ``i * horizon`` days
    before the asset's last one; its ``horizon`` days after that are held out.
    ``train`` is bounded per asset by the training cut, so the windows are too.
    """
    fold = Window.partitionBy(key, "fold")
    each = train.select(key, "ds", "y", F.max("ds").over(Window.partitionBy(key)).alias("_last")).select(
        key, "ds", "y", "_last", F.explode(F.sequence(F.lit(1), F.lit(n_folds))).alias("fold"))
    at = each.withColumn("_origin", F.max(F.when(F.col("ds") <= F.date_sub("_last", F.col("fold") * horizon), F.col("ds"))).over(fold))
    rows = at.where(F.col("ds") <= F.date_add("_origin", horizon)).withColumn("held", F.col("ds") > F.col("_origin"))
    return (rows.withColumn("_n", F.count(F.when(~F.col("held"), 1)).over(fold)).withColumn("_h", F.count(F.when(F.col("held"), 1)).over(fold))
            .where((F.col("_n") >= min_points) & (F.col("_h") > 0)).select(key, "fold", "ds", "y", "held"))


def _judged(parts: DataFrame, fitted: DataFrame, key: str, name: str) -> DataFrame:
    """Mean absolute error in shares of the price, and share of held-out days inside the band, per asset."""
    held = parts.where("held").select(key, "fold", F.col("ds").alias("date"), F.exp("y").alias("_true"))
    both = held.join(fitted.where(F.col("Type") == FC.FORECAST), [key, "fold", "date"])
    inside = ((F.col("lower_ci") <= F.col("_true")) & (F.col("_true") <= F.col("upper_ci"))).cast("double")
    return both.groupBy(key).agg(F.avg(F.abs(F.col("value") - F.col("_true")) / F.col("_true")).alias(f"{name}_error"), F.avg(inside).alias(f"{name}_inside"))


def backtest(train: DataFrame, key: str = "symbol", n_folds: int = N_FOLDS, horizon: int = DEFAULT_HORIZON,
             min_points: int = MIN_TRAIN_POINTS) -> DataFrame:
    """Per asset with a usable fold: n_folds, n_held, baseline_error, baseline_inside, model_error, model_inside.

    ``train`` is the output of ``forecast.training_set`` (stage it: three branches read it).
    """
    parts = folds(train, key, n_folds, horizon, min_points)
    known = parts.where("NOT held").select(key, "fold", "ds", "y")
    counts = parts.groupBy(key).agg(F.count_distinct("fold").alias("n_folds"), F.count(F.when(F.col("held"), 1)).alias("n_held"))
    base = _judged(parts, FC.forecast_baseline(known, [key, "fold"], horizon, with_bounds=True), key, "baseline")
    model = _judged(parts, FC.forecast_additive(known, [key, "fold"], horizon), key, "model")
    return counts.join(base, key).join(model, key)
