from pyspark.sql import functions as F

from finseries.operators import snapshot as S
from finseries.operators import trends as T


def test_latest_and_previous(spark, bars):
    df = bars([("A", "2024-01-01", 1.0), ("A", "2024-01-03", 2.0), ("B", "2024-01-05", 3.0)])
    r = S.latest_dates(df).first()
    assert str(r.latest) == "2024-01-05" and str(r.prev) == "2024-01-03"


def test_latest_dates_of_one_date_none_and_known_ones(spark, bars):
    one = bars([("A", "2024-01-01", 1.0), ("B", "2024-01-01", 2.0)])
    r = S.latest_dates(one).first()
    assert str(r.latest) == "2024-01-01" and r.prev is None
    r = S.latest_dates(one.where("false")).first()
    assert r.latest is None and r.prev is None
    known = S.know_dates(one.where("true"), r.latest, r.prev)
    assert S.latest_dates(known).first() == r


def test_lagging_asset_drops_out(spark, bars):
    df = bars([("A", "2024-01-01", 1.0), ("A", "2024-01-02", 2.0),
               ("B", "2024-01-01", 5.0)])  # B has no row on the latest date
    got = S.snapshot_change(df, "symbol", "name").collect()
    assert [r.symbol for r in got] == ["A"]
    assert got[0].close_curr == 2.0 and got[0].close_prev == 1.0 and abs(got[0].pct_change - 100.0) < 1e-9


def test_tie_at_rank_k_takes_smaller_key(spark, bars):
    rows = [(s, "2024-01-02", 1.0) for s in ["C", "B", "A", "D"]]
    got = [r.symbol for r in S.top_assets(bars(rows), "symbol", k=2).collect()]
    assert got == ["A", "B"]


def test_top_by_count_then_key(spark, bars):
    rows = [("Z", "2024-01-02", 1.0), ("Z", "2024-01-02", 2.0), ("A", "2024-01-02", 1.0)]
    got = [(r.symbol, r["count"]) for r in S.top_assets(bars(rows), "symbol", k=5).collect()]
    assert got == [("Z", 2), ("A", 1)]


def test_duplicates_do_not_pair_up(spark, bars):
    rows = [("A", "2024-01-01", 1.0), ("A", "2024-01-01", 2.0), ("A", "2024-01-02", 3.0),
            ("A", "2024-01-02", 4.0)]
    got = sorted((r.close_curr, r.close_prev) for r in S.snapshot_change(bars(rows), "symbol", "name").collect())
    assert got == [(3.0, 1.5), (4.0, 1.5)]  # one row per latest-day row, previous day averaged
    spark_rows = S.sparkline(bars(rows), "symbol", "name").collect()
    assert len(spark_rows) == 4  # each recent row once (one color)


def test_snapshot_properties(spark, bars):
    import random
    rnd = random.Random(7)
    rows = []
    for s in "ABCDEFGHIJKLMN":
        for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
            if rnd.random() < 0.7:
                rows.append((s, d, rnd.uniform(1, 10)))
    df = bars(rows)
    snap = S.snapshot_change(df, "symbol", "name", k=10).collect()
    on_last = {r[0] for r in rows if r[1] == "2024-01-03"}
    on_prev = {r[0] for r in rows if r[1] == "2024-01-02"}
    top = sorted(on_last)[:10]
    assert len(snap) <= 10
    assert {r.symbol for r in snap} == set(top) & on_prev


def test_bounds_sparkline_inclusive_compare_strict(spark, bars):
    rows = [("A", "2024-01-10", 1.0), ("A", "2024-01-03", 2.0), ("A", "2024-01-04", 3.0),
            ("A", "2024-01-09", 4.0), ("A", "2024-01-02", 9.0)]
    df = bars(rows)
    spark_days = sorted(str(r.date) for r in S.sparkline(df, "symbol", "name", days=7).collect())
    assert spark_days == ["2024-01-03", "2024-01-04", "2024-01-09", "2024-01-10"]
    oc = T.open_close(df, "symbol", "name", days=7)
    assert sorted({str(r.date) for r in oc.collect()}) == ["2024-01-04", "2024-01-09", "2024-01-10"]


def test_named_top_list(spark, bars):
    df = bars([("A", "2024-01-02", 1.0), ("B", "2024-01-02", 1.0), ("B", "2024-01-01", 1.0)])
    got = sorted((r.symbol, r.name) for r in S.top_assets_named(df, "symbol", "name").collect())
    assert got == [("A", "Name A"), ("B", "Name B")]


def test_volume_ranking(spark, bars):
    df = bars([("A", "2024-01-02", 1.0), ("B", "2024-01-02", 1.0)]).withColumn(
        "volume", F.when(F.col("symbol") == "B", 10.0).otherwise(1.0))
    assert [r.symbol for r in S.top_assets(df, "symbol", k=1, by="volume").collect()] == ["B"]
