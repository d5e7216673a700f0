import os
import tempfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from finseries.sources import adapters as A
from finseries.sources import raw as R
from finseries.sources import store as ST

from conftest import SF0001


def _tmp():
    return tempfile.mkdtemp(prefix="fs-test-")


def test_files_layout_code_from_file_name(spark):
    d = _tmp()
    for code, rows in {"BRK.B": [("2024-01-02", "1", "2", "0.5", "1.5", "100")],
                       "BTC": [("2024-01-02", "abc", "2", "0.5", " 5.5 ", "1e3")]}.items():
        pd.DataFrame(rows, columns=["date", "open", "high", "low", "close", "volume"]).to_csv(
            os.path.join(d, f"{code}.csv"), index=False)
    got = R.curate(spark, d, "stocks", layout="files", floor=None).orderBy("symbol").collect()
    assert [(r.symbol, r.stock) for r in got] == [("BRK.B", "Berkshire Hathaway Inc."), ("BTC", "Unknown")]
    btc = got[1]
    assert btc.open is None and btc.close == 5.5 and btc.volume == 1000.0


def test_header_order_mismatch_fails(spark):
    d = _tmp()
    pd.DataFrame({"date": ["2024-01-01"], "value": ["1"]}).to_csv(os.path.join(d, "cpi.csv"), index=False)
    pd.DataFrame({"value": ["2"], "date": ["2024-01-01"]}).to_csv(os.path.join(d, "federal.csv"), index=False)
    with pytest.raises(Exception):
        R.curate(spark, d, "economic_indicators", layout="files", floor=None).collect()


def test_names_exact_code_and_floors(spark):
    d = _tmp()
    for code in ["treasury", "federal", "cpiX"]:
        pd.DataFrame({"date": ["2019-12-31", "2020-01-01", "2020-02-01"], "value": ["1", "2", "x"]}).to_csv(
            os.path.join(d, f"{code}.csv"), index=False)
    got = R.curate(spark, d, "economic_indicators", layout="files").collect()
    assert {r.indicator for r in got} == {"Treasury Yield", "Federal Funds Rate", "Unknown"}
    assert {str(r.date) for r in got} == {"2020-01-01", "2020-02-01"}  # inclusive floor
    assert sorted({r.value for r in got}, key=str) == [2.0, None]
    got = R.curate(spark, d, "commodities", layout="files").collect()
    assert {str(r.date) for r in got} == {"2020-02-01"}  # strict floor
    assert {r.commodity for r in got} == {"treasury", "federal", "cpiX"}


def test_round_trip_partitioned_layout(spark):
    bars = A.long_bars(spark, SF0001)
    land = os.path.join(_tmp(), "landing")
    R.land_csv(bars, land, "stocks")
    back = R.curate(spark, land, "stocks", floor=None)
    want = bars.select("symbol", "date", "open", "high", "low", "close", "volume")
    got = back.select(*want.columns)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert back.where(F.col("symbol").contains("#")).count() > 0  # '#' survives folder escaping


def test_publish_failed_run_keeps_previous(spark):
    table = os.path.join(_tmp(), "t")
    good = spark.range(5).withColumn("x", F.col("id") * 2)
    ST.publish(good, table)
    bad = spark.range(5).withColumn("x", F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise(1))
    with pytest.raises(Exception):
        ST.publish(bad, table)
    assert sorted(r.x for r in ST.read_curated(spark, table).collect()) == [0, 2, 4, 6, 8]
    ST.publish(good.withColumn("x", F.lit(7)), table)
    assert {r.x for r in ST.read_curated(spark, table).collect()} == {7}


def test_publish_keeps_n_runs_and_single_file(spark):
    table = os.path.join(_tmp(), "t")
    for i in range(4):
        ST.publish(spark.range(10).repartition(3), table, keep=2, single_file=(i == 3))
    runs = ST.complete_runs(spark, table)
    assert len(runs) == 2
    files = [f for f in os.listdir(os.path.join(table, runs[-1])) if f.endswith(".parquet")]
    assert len(files) == 1


def test_movers_typing(spark):
    raw = spark.createDataFrame([("X", "1.5", "2", "12.5%", "100"), ("Y", "1", "n/a", "3%", "1")],
                                "ticker string, price string, change_amount string, "
                                "change_percentage string, volume string")
    from finseries.operators import movers as M
    got = M.clean_movers(raw).collect()
    assert [(r.ticker, r.change_percentage) for r in got] == [("X", 12.5)]


def test_headerless_files_named_by_position(spark):
    d = _tmp()
    with open(os.path.join(d, "ETH.csv"), "w") as f:
        f.write("2024-01-02,1,2,0.5,1.5,10\n2024-01-03,2,3,1.5,2.5,20\n")
    got = R.curate(spark, d, "crypto", layout="files", floor=None, header=False).orderBy("date").collect()
    assert [(r.symbol, r.crypto, str(r.date), r.close) for r in got] == [
        ("ETH", "Ethereum", "2024-01-02", 1.5), ("ETH", "Ethereum", "2024-01-03", 2.5)]


def test_publish_partitioned_by_date_prunes_at_run_time(spark):
    from finseries.operators import snapshot as S
    table = os.path.join(_tmp(), "bars")
    bars = A.tick_bars(spark, SF0001)
    ST.publish(bars, table, partition_by=["date"])
    back = ST.read_curated(spark, table)
    assert back.count() == bars.count()
    snap = S.snapshot_change(back, "symbol", "crypto")
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "Subquery" in plan
    want = {(r.symbol, r.close_curr) for r in S.snapshot_change(bars, "symbol", "crypto").collect()}
    assert {(r.symbol, r.close_curr) for r in snap.collect()} == want
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        S.latest_dates(back).explain("formatted")
    schemas = [l.strip() for l in buf.getvalue().splitlines() if l.startswith("ReadSchema")]
    assert schemas and all(x == "ReadSchema: struct<>" for x in schemas)  # partition values only


def test_by_name_reads_files_with_different_column_orders(spark):
    d = _tmp()
    pd.DataFrame({"date": ["2024-01-01", "2024-01-02"], "value": ["1", "2"]}).to_csv(
        os.path.join(d, "cpi.csv"), index=False)
    pd.DataFrame({"value": ["30", "40"], "date": ["2024-01-01", "2024-01-02"]}).to_csv(
        os.path.join(d, "federal.csv"), index=False)
    got = R.curate(spark, d, "economic_indicators", layout="files", floor=None, by_name=True).collect()
    assert sorted((r.indicator, str(r.date), r.value) for r in got) == [
        ("CPI", "2024-01-01", 1.0), ("CPI", "2024-01-02", 2.0),
        ("Federal Funds Rate", "2024-01-01", 30.0), ("Federal Funds Rate", "2024-01-02", 40.0)]


def test_by_name_partitioned_layout_round_trip(spark):
    bars = A.tick_bars(spark, SF0001)
    land = os.path.join(_tmp(), "landing")
    R.land_csv(bars, land, "crypto")
    a = R.read_raw(spark, land, "crypto")
    b = R.read_raw(spark, land, "crypto", by_name=True)
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_publish_sorts_rows_inside_each_file(spark):
    import glob

    import pyarrow.parquet as pq
    table = os.path.join(_tmp(), "t")
    df = spark.range(2000).selectExpr("id", "(id * 7919) % 1000 AS k").repartition(3)
    run = ST.publish(df, table, sort_within=["k"])
    files = glob.glob(os.path.join(run, "*.parquet"))
    assert files
    for f in files:
        ks = pq.read_table(f).column("k").to_pylist()
        assert ks == sorted(ks)


def test_by_name_fails_on_a_file_without_header(spark):
    d = _tmp()
    pd.DataFrame({"date": ["2024-01-01"], "value": ["1"]}).to_csv(os.path.join(d, "cpi.csv"), index=False)
    with open(os.path.join(d, "federal.csv"), "w") as f:
        f.write("2024-01-01,5\n")
    with pytest.raises(Exception):
        R.curate(spark, d, "economic_indicators", layout="files", floor=None, by_name=True).collect()


def test_land_csv_caps_rows_per_file(spark):
    import glob
    bars = A.tick_bars(spark, SF0001)
    land = os.path.join(_tmp(), "landing")
    R.land_csv(bars, land, "crypto", max_records_per_file=7)
    files = glob.glob(os.path.join(land, "symbol=*", "*.csv"))
    counts = [len(pd.read_csv(f)) for f in files]
    assert max(counts) <= 7 and sum(counts) == bars.count()


def test_empty_load_publishes_a_readable_empty_table(spark):
    table = os.path.join(_tmp(), "t")
    empty = A.tick_bars(spark, SF0001).where("1 = 0")
    ST.publish(empty, table)
    back = ST.read_curated(spark, table)
    assert back.count() == 0 and back.columns == empty.columns
