"""Snapshot and history against a pandas rendition of the source's steps, on random bars."""

import datetime as dt
import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from finseries.operators import snapshot as S
from finseries.operators import trends as T

BASE = dt.date(2024, 1, 1)
closes = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.5, 3.0, 10.0]))
bar_sets = st.lists(st.tuples(st.sampled_from("ABCDEFGHIJKL"), st.integers(0, 20), closes),
                    min_size=1, max_size=80, unique_by=lambda t: (t[0], t[1]))


def _spark_bars(spark, rows):
    data = [(s, f"Name {s}", BASE + dt.timedelta(days=d), c, c, c, c, 1.0) for s, d, c in rows]
    return spark.createDataFrame(data, "symbol string, name string, date date, open double, high double, "
                                       "low double, close double, volume double")


def _pandas_snapshot(rows, k=10):
    df = pd.DataFrame(rows, columns=["symbol", "d", "close"])
    df["close"] = df["close"].astype(float)
    df["date"] = [BASE + dt.timedelta(days=d) for d in df["d"]]
    latest = df["date"].max()
    prev = df[df["date"] < latest]["date"].max()
    last = df[df["date"] == latest]
    counts = last["symbol"].value_counts()
    top = sorted(counts.index, key=lambda s: (-counts[s], s))[:k]
    cur = last[last["symbol"].isin(top)]
    pv = df[(df["date"] == prev) & df["symbol"].isin(top)]
    m = pd.merge(cur, pv, on="symbol", suffixes=("_curr", "_prev"))
    out = set()
    for _, r in m.iterrows():
        c, p = r["close_curr"], r["close_prev"]
        pct = (c - p) / p * 100 if p == p and c == c and p != 0 else float("nan")
        up = (pct > 0) or (p == 0 and c > 0)  # a rise from zero is +inf in pandas
        out.add((r["symbol"], None if math.isnan(pct) else round(pct, 9), "▲" if up else "▼"))
    return out


@settings(max_examples=25, deadline=None)
@given(bar_sets)
def test_snapshot_matches_pandas(spark, rows):
    got = {(r.symbol, None if r.pct_change is None else round(r.pct_change, 9), r.arrow)
           for r in S.snapshot_change(_spark_bars(spark, rows), "symbol", "name").collect()}
    assert got == _pandas_snapshot(rows)


@settings(max_examples=25, deadline=None)
@given(bar_sets, st.sampled_from(["5D", "1M", 3]))
def test_history_matches_pandas(spark, rows, span):
    got = {(r.symbol, r.date, r.color) for r in T.history(_spark_bars(spark, rows), "symbol", span).collect()}
    df = pd.DataFrame(rows, columns=["symbol", "d", "close"])
    df["close"] = df["close"].astype(float)
    df["date"] = [BASE + dt.timedelta(days=d) for d in df["d"]]
    latest = df["date"].max()
    days = T.span_days(span)
    want = set()
    for s, g in df[df["date"] > latest - dt.timedelta(days=days)].sort_values("date").groupby("symbol"):
        first, last = g["close"].iloc[0], g["close"].iloc[-1]
        color = "green" if len(g) > 1 and last >= first else "gray"  # NaN compares False
        want |= {(s, d, color) for d in g["date"]}
    assert got == want
