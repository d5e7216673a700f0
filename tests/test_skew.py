"""One asset holds most rows (with repeated dates); results must equal brute force."""

import datetime as dt
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from finseries.operators import forecast as FC
from finseries.operators import indicators as I
from finseries.operators import trends as T


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    base = dt.date(2021, 1, 1)
    rows = []
    for i in range(3000):  # hot asset: 1500 days, two rows per day
        d = base + dt.timedelta(days=i // 2)
        rows.append(("HOT", d, round(rnd.uniform(10, 20), 2)))
    for s in ["A", "B", "C"]:
        for i in range(40):
            rows.append((s, base + dt.timedelta(days=1460 + i), round(rnd.uniform(1, 5), 2)))
    pdf = pd.DataFrame(rows, columns=["symbol", "date", "close"])
    df = spark.createDataFrame(pdf).withColumn("date", F.col("date").cast("date")).repartition(7)
    return pdf, df


def test_training_set_matches_pandas(spark, skewed):
    pdf, df = skewed
    got = {(r.symbol, r.ds, round(r.y, 9)) for r in FC.training_set(df).collect()}
    want = set()
    for s, g in pdf.groupby("symbol"):
        daily = g.groupby("date")["close"].mean().sort_index()
        if len(daily) < 30:
            continue
        for d, p in daily.tail(120).items():
            want.add((s, d, round(math.log(p), 9)))
    assert got == want


def test_history_color_matches_pandas(spark, skewed):
    pdf, df = skewed
    bars = df.select("symbol", "date", F.col("close").alias("open"), F.col("close").alias("high"),
                     F.col("close").alias("low"), "close", F.lit(1.0).alias("volume"))
    dedup = bars.groupBy("symbol", "date").agg(F.max("close").alias("close")).select(
        "symbol", "date", *[F.col("close").alias(c) for c in ["open", "high", "low", "close"]],
        F.lit(1.0).alias("volume"))
    got = {(r.symbol, r.color) for r in T.history(dedup, "symbol", "6M").collect()}
    p = pdf.groupby(["symbol", "date"])["close"].max().reset_index()
    latest = p["date"].max()
    want = set()
    for s, g in p[p["date"] > latest - dt.timedelta(days=182)].sort_values("date").groupby("symbol"):
        want.add((s, "green" if len(g) > 1 and g["close"].iloc[-1] >= g["close"].iloc[0] else "gray"))
    assert got == want


def test_rolling_on_hot_series_matches_pandas(spark, skewed):
    pdf, df = skewed
    ind = df.select(F.col("symbol").alias("indicator"), "date", F.col("close").alias("value"))
    got = {(r.indicator, r.date, r.value, None if r.rolling_avg is None else round(r.rolling_avg, 9))
           for r in I.rolling_mean(ind, window=4).collect()}
    p = pdf.rename(columns={"symbol": "indicator", "close": "value"}).sort_values(
        ["indicator", "date", "value"], kind="stable")
    p["r"] = p.groupby("indicator")["value"].transform(lambda s: s.rolling(4).mean())
    want = {(a, b, c, None if math.isnan(r) else round(r, 9)) for a, b, c, r in p.itertuples(index=False)}
    assert got == want
