"""Views that give the shared test tables the shapes of the market tables.

* long bars (stocks): ``lineitem`` joined to ``part``; one bar per brand and
  ship date.  ``(l_orderkey, l_linenumber)`` is not unique, so open and close
  are picked by (order key, line number, price), which is deterministic.
* tick bars (crypto): ``events``; one bar per event type and day, open and
  close picked by ``event_id``.
* indicators: ``orders``; one value per order status and month.
* movers as text: ``part`` rendered as the all-string movers file.

Every view is a lazy DataFrame over the parquet scan, so filters on
``symbol``/``date`` placed on top are pushed below the aggregate (both are
grouping keys) and only the needed columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


#: Known columns of the tables that the views read: declared, so building a view starts no job to infer them.
SCHEMAS = {
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of one test table; its files are looked up on every call, its schema is the declared one if there is one."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def long_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, stock, date, open, high, low, close, volume (stocks shape)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
        F.col("l_shipdate").cast("date").alias("date"))
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("symbol"))
    # part grows with the data: no broadcast hint, AQE decides from its
    # runtime size and splits a skewed part key if one dominates.
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    # (order key, line, price in cents) as one decimal: a hash aggregate can hold it, a struct would need a sort
    cents = F.round(F.col("l_extendedprice") * 100).cast("decimal(12,0)")
    pick = (F.col("l_orderkey").cast("decimal(19,0)") * F.lit(10 ** 15).cast("decimal(16,0)")
            + F.col("l_linenumber").cast("decimal(3,0)") * F.lit(10 ** 12).cast("decimal(13,0)") + cents).cast("decimal(38,0)")
    price = lambda c: (c % F.lit(10 ** 12).cast("decimal(13,0)")).cast("double") / F.lit(100.0)
    bars = j.groupBy("symbol", "date").agg(
        price(F.min(pick)).alias("open"),
        F.max("l_extendedprice").alias("high"),
        F.min("l_extendedprice").alias("low"),
        price(F.max(pick)).alias("close"),
        F.sum("l_quantity").alias("volume"),
    )
    return bars.select("symbol", F.concat(F.lit("Stock "), F.col("symbol")).alias("stock"),
                       "date", "open", "high", "low", "close", "volume")


def tick_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, crypto, date, open, high, low, close, volume (crypto shape)."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("symbol"), F.col("ts").cast("date").alias("date"),
        "value")
    bars = ev.groupBy("symbol", "date").agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        F.count(F.lit(1)).cast("double").alias("volume"),
    )
    return bars.select("symbol", F.upper("symbol").alias("crypto"), "date",
                       "open", "high", "low", "close", "volume")


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """indicator, date, value (monthly series, economic indicator shape).

    The value is the monthly mean price, taken as an exact integer sum of
    cents divided by the count: the same IEEE operations in any engine, so no
    rounding step (and no rounding tie) is needed to compare engines.
    """
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("indicator"),
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("date"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("_cents"))
    return o.groupBy("indicator", "date").agg(
        (F.sum("_cents").cast("double") / F.count(F.lit(1)) / F.lit(100.0)).alias("value"))


def movers_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ticker, price, change_amount, change_percentage, volume, all as text.

    Every part row becomes one mover row.  The modulo terms only shape the
    values: one ticker in 17 gets the unparseable percent text ``n/a`` (the
    bad-number trap), and change amounts repeat so that ties at rank 10 occur.
    Nothing is filtered here.
    """
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("ticker"),
        F.col("p_retailprice").cast("string").alias("price"),
        ((F.col("p_partkey") * 31) % 97).cast("string").alias("change_amount"),
        F.when(F.col("p_partkey") % 17 == 0, F.lit("n/a"))
         .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("%")))
         .alias("change_percentage"),
        (F.col("p_partkey") * 100 + F.col("p_size")).cast("string").alias("volume"),
    )


# The same views in DuckDB SQL, for the oracle queries.
LONG_BARS_SQL = """
SELECT symbol, 'Stock ' || symbol AS stock, date, open, high, low, close, volume FROM (
  SELECT p.p_brand AS symbol, CAST(l.l_shipdate AS DATE) AS date,
         min({'o': l.l_orderkey, 'n': l.l_linenumber, 'x': l.l_extendedprice}).x AS open,
         max(l.l_extendedprice) AS high,
         min(l.l_extendedprice) AS low,
         max({'o': l.l_orderkey, 'n': l.l_linenumber, 'x': l.l_extendedprice}).x AS close,
         sum(l.l_quantity) AS volume
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY 1, 2)
"""

TICK_BARS_SQL = """
SELECT symbol, upper(symbol) AS crypto, date, open, high, low, close, volume FROM (
  SELECT event_type AS symbol, CAST(ts AS DATE) AS date,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)
"""

INDICATORS_SQL = """
SELECT o_orderstatus AS indicator, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS date,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100.0 AS value
FROM orders GROUP BY 1, 2
"""

MOVERS_TEXT_SQL = """
SELECT CAST(p_partkey AS VARCHAR) AS ticker,
       CAST(p_retailprice AS VARCHAR) AS price,
       CAST((p_partkey * 31) % 97 AS VARCHAR) AS change_amount,
       CASE WHEN p_partkey % 17 = 0 THEN 'n/a' ELSE CAST(p_size AS VARCHAR) || '%' END AS change_percentage,
       CAST(p_partkey * 100 + p_size AS VARCHAR) AS volume
FROM part
"""


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the adapter views it uses as CTEs (L, T, N, M)."""
    defs = {"L": LONG_BARS_SQL, "T": TICK_BARS_SQL, "N": INDICATORS_SQL, "M": MOVERS_TEXT_SQL}
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in names)
    body = sql.strip()
    # ``sql`` may start with more CTE definitions of its own
    sep = "\n" if body[:6].upper() == "SELECT" else ",\n"
    return f"WITH {ctes}{sep}{body}"
