import datetime as dt
import math
import re
from collections import Counter

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from finseries.operators import indicators as I


def _ind(spark, rows):
    return spark.createDataFrame(rows, "indicator string, date date, value double")


def test_rolling_gap(spark):
    vals = [1.0, 2.0, None, 4.0, 5.0, 6.0]
    rows = [("X", dt.date(2024, 1, 1) + dt.timedelta(days=i), v) for i, v in enumerate(vals)]
    got = I.rolling_mean(_ind(spark, rows)).orderBy("date").collect()
    assert [r.rolling_avg for r in got] == [None] * 5 + [5.0]


def _pandas_rolling(rows, w):
    pdf = pd.DataFrame(rows, columns=["indicator", "date", "value"])
    pdf["_v"] = pdf["value"].astype(float).fillna(float("-inf"))
    pdf = pdf.sort_values(["indicator", "date", "_v"], kind="stable")
    pdf["r"] = pdf.groupby("indicator")["value"].transform(lambda s: s.rolling(w).mean())
    return Counter((a, str(b), None if c is None or (isinstance(c, float) and math.isnan(c)) else c,
                    None if math.isnan(r) else round(r, 9))
                   for a, b, c, r in pdf[["indicator", "date", "value", "r"]].itertuples(index=False))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 2000),
                          st.one_of(st.none(), st.integers(-50, 50).map(float))),
                min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 4))
def test_rolling_matches_pandas_across_buckets(spark, data, w):
    base = dt.date(2019, 12, 1)
    rows = [(k, base + dt.timedelta(days=d), v) for k, d, v in data]
    df = _ind(spark, rows)
    # monthly buckets make many bucket edges, some buckets with a single row
    got = I.rolling_mean(df, window=w, bucket=F.trunc("date", "MM")).collect()
    mine = Counter((r.indicator, str(r.date), r.value,
                    None if r.rolling_avg is None else round(r.rolling_avg, 9)) for r in got)
    assert mine == _pandas_rolling(rows, w)


def test_yoy_and_calendar(spark):
    rows = [("X", dt.date(2023, 3, 1), 1.0), ("X", dt.date(2024, 3, 1), 2.0), ("X", dt.date(2022, 3, 1), 3.0),
            ("Y", dt.date(2023, 3, 1), 4.0)]
    got = I.yoy(_ind(spark, rows), ["X"], (2023, 2024)).orderBy("legend").collect()
    assert [(r.legend, r.month, r.month_name, r.value) for r in got] == [("2023", 3, "Mar", 1.0), ("2024", 3, "Mar", 2.0)]


def test_sorted_values(spark):
    rows = [("b", dt.date(2023, 3, 1), 1.0), ("a", dt.date(2024, 3, 1), 2.0), (None, dt.date(2024, 3, 1), 2.0)]
    assert [r[0] for r in I.sorted_values(_ind(spark, rows), "indicator").collect()] == ["a", "b"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40),
                          st.one_of(st.none(), st.integers(-3, 3).map(float))),
                min_size=1, max_size=120),
       st.integers(1, 4), st.integers(1, 9))
def test_range_buckets_match_pandas_with_copies(spark, data, w, n):
    # repeated (series, day, value) rows: copies must be split and still give pandas' answer
    base = dt.date(2024, 1, 1)
    rows = [(k, base + dt.timedelta(days=d), v) for k, d, v in data]
    got = I.rolling_mean(_ind(spark, rows), window=w, n_buckets=n).collect()
    mine = Counter((r.indicator, str(r.date), r.value,
                    None if r.rolling_avg is None else round(r.rolling_avg, 9)) for r in got)
    assert mine == _pandas_rolling(rows, w)


def test_hot_group_of_copies_is_split(spark):
    rows = [("hot", dt.date(2024, 1, 1), 1.0)] * 3000 + [("x", dt.date(2024, 1, 2), 2.0)] * 10
    df = I._range_buckets(_ind(spark, rows).select("indicator", "date", "value"), "indicator",
                          ["date", "value"], 8)
    sizes = [r["count"] for r in df.groupBy("_b").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 3000
    got = I.rolling_mean(_ind(spark, rows), window=3, n_buckets=8).where("indicator = 'hot'")
    assert got.where("rolling_avg IS NULL").count() == 2 and got.where("rolling_avg = 1.0").count() == 2998


def test_rows_without_series_are_left_out(spark):
    rows = [(None, dt.date(2024, 1, 1), 1.0), ("a", dt.date(2024, 1, 1), 2.0)]
    got = [(r.indicator, r.rolling_avg) for r in I.rolling_mean(_ind(spark, rows), window=1).collect()]
    assert got == [("a", 2.0)]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 40),
                          st.one_of(st.none(), st.integers(-300, 300).map(lambda x: x / 4))),
                min_size=1, max_size=120),
       st.sampled_from([1, 2, 3, 7, 30, 200]), st.integers(1, 9))
def test_exact_means_of_any_width_match_pandas(spark, data, w, n):
    base = dt.date(2024, 1, 1)
    rows = [(k, base + dt.timedelta(days=d), v) for k, d, v in data]
    got = I.rolling_mean_exact(_ind(spark, rows), window=w, n_buckets=n).collect()
    mine = Counter((r.indicator, str(r.date), r.value,
                    None if r.rolling_avg is None else round(r.rolling_avg, 9)) for r in got)
    assert mine == _pandas_rolling(rows, w)


def test_exact_means_cost_the_same_at_any_width(spark):
    rows = [("hot", dt.date(2024, 1, 1) + dt.timedelta(days=i // 3), float(i % 7)) for i in range(3000)] + [("x", dt.date(2024, 1, 2), 2.0)]
    df = _ind(spark, rows)

    def plan(w):
        return I.rolling_mean_exact(df, window=w, n_buckets=8)._jdf.queryExecution().executedPlan().toString()
    shapes = [re.findall(r"^[ :+*()0-9-]*([A-Za-z]+)", plan(w), re.M) for w in (3, 200)]
    assert shapes[0] == shapes[1] and "lag(" not in plan(200)
    got = I.rolling_mean_exact(df, window=200, n_buckets=8)
    assert got.count() == 3001 and got.where("indicator = 'hot' AND rolling_avg IS NULL").count() == 199


def test_exact_means_of_odd_values(spark):
    day = dt.date(2024, 1, 1)
    vals = [1.0, float("inf"), 2.0, 3.0, float("nan"), 1e30, 4.0, 5.0]
    rows = [("a", day + dt.timedelta(days=i), v) for i, v in enumerate(vals)] + [(None, day, 1.0)]
    got = I.rolling_mean_exact(_ind(spark, rows), window=2).orderBy("date").collect()
    assert [r.rolling_avg for r in got] == [None, None, None, 2.5, None, None, None, 4.5]
    assert I.rolling_mean_exact(_ind(spark, []), window=2).count() == 0
