from finseries.operators import trends as T


def test_one_row_history_is_gray(spark, bars):
    df = bars([("A", "2024-01-10", 1.0)])
    assert [r.color for r in T.history(df, "symbol", "5D").collect()] == ["gray"]


def test_history_color_and_strict_bound(spark, bars):
    df = bars([("A", "2024-01-10", 2.0), ("A", "2024-01-06", 1.0), ("A", "2024-01-05", 9.0),
               ("B", "2024-01-10", 1.0), ("B", "2024-01-08", 2.0)])
    got = {(r.symbol, str(r.date), r.color) for r in T.history(df, "symbol", "5D").collect()}
    assert got == {("A", "2024-01-10", "green"), ("A", "2024-01-06", "green"),
                   ("B", "2024-01-10", "gray"), ("B", "2024-01-08", "gray")}


def test_history_by_name(spark, bars):
    df = bars([("A", "2024-01-10", 2.0), ("B", "2024-01-10", 1.0)])
    got = [r.symbol for r in T.history(df, "symbol", "1M", assets=["Name B"], by_name="name").collect()]
    assert got == ["B"]


def test_open_close_two_rows_per_asset_and_date(spark, bars):
    rows = [(s, f"2024-01-{d:02d}", float(d), float(d) + 0.5) for s in "ABC" for d in range(1, 11)]
    out = T.open_close(bars(rows), "symbol", "name", k=10, days=7).collect()
    per = {}
    for r in out:
        per.setdefault((r.symbol, r.date), []).append(r.series)
    assert len(per) == 3 * 7
    assert all(sorted(v) == sorted([f"Name {k[0]} - Open", f"Name {k[0]} - Close"]) for k, v in per.items())


def test_span_labels():
    assert [T.span_days(x) for x in ["5D", "1M", "6M", "YTD", "1Y", "5Y", 12]] == [5, 30, 182, 90, 365, 1825, 12]


def test_calendar_ytd_option(spark, bars):
    df = bars([("A", "2024-03-10", 2.0), ("A", "2024-01-01", 1.0), ("A", "2023-12-31", 9.0)])
    got = sorted(str(r.date) for r in T.history(df, "symbol", T.CALENDAR_YTD).collect())
    assert got == ["2024-01-01", "2024-03-10"]
    fixed = sorted(str(r.date) for r in T.history(df, "symbol", "YTD").collect())
    assert fixed == ["2023-12-31", "2024-01-01", "2024-03-10"]  # fixed 90 days
    assert len(T.history(df, "symbol", 40).collect()) == 1
