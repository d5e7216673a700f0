"""The driver contract: every catalogue query of the blueprint stays registered."""

import __spark_entry__ as E

# query names of the build plan's catalogue
CATALOGUE = [
    "raw_csv_roundtrip", "curate_stocks", "curate_crypto", "curate_indicators", "curate_commodities",
    "coerce_numbers", "calendar_columns", "latest_dates", "top_assets_latest", "top_assets_all",
    "top_assets_named", "stock_snapshot", "crypto_snapshot", "stock_sparkline", "crypto_sparkline",
    "stock_history", "crypto_history", "stock_open_close", "crypto_open_close", "asset_list",
    "indicator_years", "indicator_yoy", "indicator_rolling", "movers_top", "training_set",
    "forecast_baseline", "forecast_combined_baseline", "forecast_additive",
]


def test_catalogue_is_registered():
    assert set(CATALOGUE) <= set(E.queries())


def test_every_query_takes_spark_and_folder():
    import inspect
    for name, fn in E.queries().items():
        assert len(inspect.signature(fn).parameters) == 2, name



def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="movers_top")
    out = subprocess.run([sys.executable, os.path.join(repo, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, cwd="/tmp")
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert out.returncode == 0 and len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d) and d["unit"] == "sec"
    assert d["sf"] == 0.001 and set(d["queries"]) == {"movers_top"}
