import os
import tempfile

import pandas as pd

from finseries.sources import store as ST
from finseries.streaming.ingest import republish_on_arrival


def _land(d, code, days):
    pd.DataFrame({"date": days, "open": "1", "high": "2", "low": "0.5", "close": "1.5", "volume": "9"}).to_csv(
        os.path.join(d, f"{code}.csv"), index=False)


def test_republish_only_when_files_arrive(spark):
    root = tempfile.mkdtemp(prefix="fs-stream-")
    landing, table = os.path.join(root, "landing"), os.path.join(root, "table")
    os.makedirs(landing)
    _land(landing, "BTC", ["2024-01-01", "2024-01-02"])
    _land(landing, "ETH", ["2024-01-02"])
    assert len(republish_on_arrival(spark, landing, "crypto", table, layout="files")) == 1
    assert ST.read_curated(spark, table).count() == 3
    assert republish_on_arrival(spark, landing, "crypto", table, layout="files") == []
    _land(landing, "SOL", ["2024-01-03"])
    assert len(republish_on_arrival(spark, landing, "crypto", table, layout="files")) == 1
    got = {(r.symbol, r.crypto) for r in ST.read_curated(spark, table).collect()}
    assert got == {("BTC", "Bitcoin"), ("ETH", "Ethereum"), ("SOL", "Solana")}


def test_overwritten_unchanged_and_deleted_files(spark):
    root = tempfile.mkdtemp(prefix="fs-stream-")
    landing, table = os.path.join(root, "landing"), os.path.join(root, "table")
    os.makedirs(landing)

    def run():
        return len(republish_on_arrival(spark, landing, "crypto", table, layout="files"))

    def days(code):
        return sorted(str(r.date) for r in ST.read_curated(spark, table).where(f"symbol = '{code}'").collect())

    assert run() == 0  # nothing landed yet
    _land(landing, "BTC", ["2024-01-01"])
    _land(landing, "ETH", ["2024-01-01"])
    assert run() == 1 and run() == 0
    _land(landing, "BTC", ["2024-01-01", "2024-01-02"])  # overwritten in place
    assert run() == 1 and run() == 0
    assert days("BTC") == ["2024-01-01", "2024-01-02"] and days("ETH") == ["2024-01-01"]
    os.remove(os.path.join(landing, "ETH.csv"))
    assert run() == 1 and run() == 0
    assert days("ETH") == [] and days("BTC") == ["2024-01-01", "2024-01-02"]
    os.remove(os.path.join(landing, "BTC.csv"))
    assert run() == 1 and ST.read_curated(spark, table).count() == 0


def test_partitioned_landing_with_escaped_codes(spark):
    from finseries.sources import raw as R
    root = tempfile.mkdtemp(prefix="fs-stream-")
    landing, table = os.path.join(root, "landing"), os.path.join(root, "table")
    rows = spark.createDataFrame([("A#1", "2024-01-01", 1.0), ("B+2", "2024-01-01", 2.0)], "symbol string, date string, close double")
    full = rows.selectExpr("symbol", "date", "close AS open", "close AS high", "close AS low", "close", "close AS volume")
    R.land_csv(full, landing, "crypto")
    assert len(republish_on_arrival(spark, landing, "crypto", table)) == 1
    extra = full.selectExpr("symbol", "'2024-01-02' AS date", "open", "high", "low", "close", "volume")
    extra.write.mode("append").option("header", True).partitionBy("symbol").csv(landing)
    assert len(republish_on_arrival(spark, landing, "crypto", table)) == 1
    assert {(r.symbol, str(r.date)) for r in ST.read_curated(spark, table).collect()} == {
        (s, d) for s in ("A#1", "B+2") for d in ("2024-01-01", "2024-01-02")}
