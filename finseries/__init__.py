"""finseries: daily market data on Spark.

Landed per-asset CSV files are typed and published as Parquet; the analytic
questions (latest-day snapshot, trends, open/close comparison, indicator
views, top movers, forecasts) are functions from DataFrame to DataFrame.
"""

__version__ = "0.1.0"
