import os
import tempfile

import pandas as pd

from finseries.__main__ import main
from finseries.sources import store


def test_curate_then_query(spark, capsys):
    root = tempfile.mkdtemp(prefix="fs-cli-")
    landing, table, out = (os.path.join(root, x) for x in ("landing", "table", "out"))
    os.makedirs(landing)
    for code, shift in (("BTC", 0.0), ("ETH", 1.0)):
        pd.DataFrame({"date": ["2024-01-01", "2024-01-02"], "open": ["1", "2"], "high": ["2", "3"],
                      "low": ["0.5", "1"], "close": [str(1 + shift), str(3 + shift)], "volume": ["9", "9"]}
                     ).to_csv(os.path.join(landing, f"{code}.csv"), index=False)
    assert main(["curate", "--dataset", "crypto", "--landing", landing, "--table", table]) == 0
    assert store.read_curated(spark, table).count() == 4
    assert main(["query", "snapshot", "--table", table, "--dataset", "crypto", "--out", out]) == 0
    got = {(r.symbol, r.crypto, r.arrow) for r in spark.read.parquet(out).collect()}
    assert got == {("BTC", "Bitcoin", "▲"), ("ETH", "Ethereum", "▲")}


def test_forecast_question(spark):
    root = tempfile.mkdtemp(prefix="fs-cli-")
    landing, table, out = (os.path.join(root, x) for x in ("landing", "table", "out"))
    os.makedirs(landing)
    days = pd.date_range("2024-01-01", periods=40).strftime("%Y-%m-%d")
    pd.DataFrame({"date": days, "open": "1", "high": "2", "low": "0.5",
                  "close": [str(10 + i * 0.1) for i in range(40)], "volume": "9"}).to_csv(
        os.path.join(landing, "SOL.csv"), index=False)
    main(["curate", "--dataset", "crypto", "--landing", landing, "--table", table])
    main(["query", "forecast", "--table", table, "--dataset", "crypto", "--horizon", "5", "--out", out])
    counts = {r.Type: r["count"] for r in spark.read.parquet(out).groupBy("Type").count().collect()}
    assert counts == {"Actual": 30, "Fitted": 40, "Forecast": 5}


def test_movers_question_drops_incomplete_rows(spark):
    root = tempfile.mkdtemp(prefix="fs-cli-")
    landing, table, out = (os.path.join(root, x) for x in ("landing", "table", "out"))
    os.makedirs(landing)
    pd.DataFrame({"ticker": ["A", "B", "C"], "price": ["1", "2", "3"], "change_amount": ["5", "9", "n/a"],
                  "change_percentage": ["1%", "n/a", "3%"], "volume": ["1", "1", "1"]}).to_csv(
        os.path.join(landing, "top_gainers.csv"), index=False)
    main(["curate", "--dataset", "top_gainers", "--landing", landing, "--table", table])
    main(["query", "movers", "--table", table, "--dataset", "top_gainers", "--out", out])
    assert [(r.ticker, r.change_percentage_display) for r in spark.read.parquet(out).collect()] == [("A", "1.00%")]


def test_open_close_series_use_display_names(spark):
    root = tempfile.mkdtemp(prefix="fs-cli-")
    landing, table, out = (os.path.join(root, x) for x in ("landing", "table", "out"))
    os.makedirs(landing)
    pd.DataFrame({"date": ["2024-01-01", "2024-01-02"], "open": "1", "high": "2", "low": "0.5",
                  "close": "1.5", "volume": "9"}).to_csv(os.path.join(landing, "AAPL.csv"), index=False)
    main(["curate", "--dataset", "stocks", "--landing", landing, "--table", table, "--floor", "none"])
    main(["query", "open_close", "--table", table, "--dataset", "stocks", "--out", out])
    assert {r.series for r in spark.read.parquet(out).collect()} == {"Apple Inc. - Open", "Apple Inc. - Close"}


def test_history_for_chosen_names(spark):
    root = tempfile.mkdtemp(prefix="fs-cli-")
    landing, table, out = (os.path.join(root, x) for x in ("landing", "table", "out"))
    os.makedirs(landing)
    for code in ("BTC", "ETH"):
        pd.DataFrame({"date": ["2024-01-01", "2024-01-02"], "open": "1", "high": "2", "low": "0.5",
                      "close": ["1", "2"], "volume": "9"}).to_csv(os.path.join(landing, f"{code}.csv"), index=False)
    main(["curate", "--dataset", "crypto", "--landing", landing, "--table", table])
    main(["query", "history", "--table", table, "--dataset", "crypto", "--assets", "Ethereum", "--out", out])
    got = {(r.symbol, r.color) for r in spark.read.parquet(out).collect()}
    assert got == {("ETH", "green")}


def test_watch_publishes_only_with_new_files(spark, capsys):
    root = tempfile.mkdtemp(prefix="fs-cli-")
    landing, table = os.path.join(root, "landing"), os.path.join(root, "table")
    os.makedirs(landing)
    pd.DataFrame({"date": ["2024-01-01"], "open": "1", "high": "2", "low": "0.5", "close": "1.5",
                  "volume": "9"}).to_csv(os.path.join(landing, "DOT.csv"), index=False)
    args = ["watch", "--dataset", "crypto", "--landing", landing, "--table", table]
    main(args)
    first = capsys.readouterr().out.split()
    main(args)
    second = capsys.readouterr().out.split()
    assert len(first) == 1 and second == []
    assert {r.crypto for r in store.read_curated(spark, table).collect()} == {"Polkadot"}
