"""Schemas of the raw and published tables, and fixed lookup values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the source system's for the same results.
# ---------------------------------------------------------------------------

# Asset codes whose files are landed.
STOCK_CODES = ["AAPL", "MSFT", "TSLA", "NVDA", "AMZN", "GOOGL", "META", "BRK.B", "JPM", "V"]
CRYPTO_CODES = ["BTC", "ETH", "USDT", "XRP", "ADA", "SOL", "DOGE", "DOT", "LTC", "BCH"]
INDICATOR_CODES = ["treasury", "federal", "cpi"]
COMMODITY_CODES = ["natgas", "aluminum", "brent", "coffee", "copper", "corn", "cotton",
                   "sugar", "wheat", "wti"]

# Display names by code; anything else is "Unknown".
STOCK_NAMES = {
    "TSLA": "Tesla Inc.",
    "AAPL": "Apple Inc.",
    "MSFT": "Microsoft Corp.",
    "NVDA": "NVIDIA Corp.",
    "AMZN": "Amazon.com Inc.",
    "GOOGL": "Alphabet Inc. (Google)",
    "META": "Meta Platforms Inc.",
    "BRK.B": "Berkshire Hathaway Inc.",
    "JPM": "JPMorgan Chase & Co",
    "V": "Visa Inc.",
}
CRYPTO_NAMES = {
    "BTC": "Bitcoin",
    "ETH": "Ethereum",
    "USDT": "Tether",
    "XRP": "XRP",
    "ADA": "Cardano",
    "SOL": "Solana",
    "DOGE": "Dogecoin",
    "DOT": "Polkadot",
    "LTC": "Litecoin",
    "BCH": "Bitcoin Cash",
}
INDICATOR_NAMES = {
    "treasury": "Treasury Yield",
    "federal": "Federal Funds Rate",
    "cpi": "CPI",
}
UNKNOWN_NAME = "Unknown"

# Look-back spans in days by label ("YTD" is a fixed 90 days).
RANGE_DAYS = {"5D": 5, "1M": 30, "6M": 182, "YTD": 90, "1Y": 365, "5Y": 1825}

# Landing date floors: strict for stocks and commodities, inclusive for
# indicators, none for crypto.
DATE_FLOOR = "2020-01-01"

# Forecast settings.
MIN_TRAIN_POINTS = 30
MAX_TRAIN_POINTS = 120
DEFAULT_HORIZON = 15
DEFAULT_SHOW_LAST = 30

# ---------------------------------------------------------------------------
# Dataset layouts
# ---------------------------------------------------------------------------

OHLCV = ["open", "high", "low", "close", "volume"]

# Column names of the landed CSV files, in file order where it is known.
RAW_COLUMNS = {
    "stocks": ["date", *OHLCV],
    "crypto": ["date", *OHLCV],
    "economic_indicators": ["date", "value"],
    "commodities": ["date", "value"],
    "top_gainers": ["ticker", "price", "change_amount", "change_percentage", "volume"],
}

# Per dataset: column holding the code derived from the file (or partition
# folder), the name column filled from the name table, the name table, the
# date floor and whether the floor is inclusive.
DATASETS = {
    "stocks": dict(code="symbol", name="stock", names=STOCK_NAMES, floor=DATE_FLOOR, inclusive=False,
                   numbers=OHLCV),
    "crypto": dict(code="symbol", name="crypto", names=CRYPTO_NAMES, floor=None, inclusive=False,
                   numbers=OHLCV),
    "economic_indicators": dict(code="code", name="indicator", names=INDICATOR_NAMES, floor=DATE_FLOOR,
                                inclusive=True, numbers=["value"]),
    "commodities": dict(code="commodity", name=None, names=None, floor=DATE_FLOOR, inclusive=False,
                        numbers=["value"]),
    "top_gainers": dict(code=None, name=None, names=None, floor=None, inclusive=False,
                        numbers=["price", "change_amount", "change_percentage", "volume"]),
}


def _typed(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


_D, _S, _X = T.DateType(), T.StringType(), T.DoubleType()

PUBLISHED_SCHEMAS = {
    "stocks": _typed([("symbol", _S), ("stock", _S), ("date", _D), *[(c, _X) for c in OHLCV]]),
    "crypto": _typed([("symbol", _S), ("crypto", _S), ("date", _D), *[(c, _X) for c in OHLCV]]),
    "economic_indicators": _typed([("indicator", _S), ("date", _D), ("value", _X)]),
    "commodities": _typed([("commodity", _S), ("date", _D), ("value", _X)]),
    "top_gainers": _typed([("ticker", _S), ("price", _X), ("change_amount", _X),
                           ("change_percentage", _X), ("volume", _X)]),
}


def raw_schema(dataset: str, partition_col: str | None = None) -> T.StructType:
    """All-string schema of a landed CSV dataset (plus the partition column)."""
    cols = list(RAW_COLUMNS[dataset])
    if partition_col:
        cols.append(partition_col)
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])
