"""Registered queries and their DuckDB SQL twins.

Each query takes ``(spark, sf_dir)``, builds the adapter view it needs from
the whole test tables and returns a DataFrame.  Most are lazy; the ingest
queries first land and publish files, and the forecast queries first stage
their training set, both under the shared scratch folder.  The SQL twin computes
the same rows from the same parquet tables (registered as views named after
the tables).  Column names are identical on both sides.

Views: L = long bars (stocks), T = tick bars (crypto), N = indicators,
M = movers as text; see ``finseries.sources.adapters``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from finseries.operators import backtest as BT
from finseries.operators import forecast as FC
from finseries.operators import indicators as I_
from finseries.operators import movers as M_
from finseries.operators import snapshot as S
from finseries.operators import trends as T_
from finseries.plans import sqlparts as Q
from finseries.schemas import CRYPTO_CODES, CRYPTO_NAMES, INDICATOR_NAMES, RANGE_DAYS, STOCK_CODES, STOCK_NAMES
from finseries.sources import adapters as A
from finseries.sources.adapters import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# Parameters of the registered queries.
K_LATEST, K_ALL = 10, 20
SPARK_DAYS = 7

# --------------------------------------------------------------------------
# Latest dates and top lists
# --------------------------------------------------------------------------


@register("latest_dates", with_views(f"{Q.dates('L')}\nSELECT (SELECT latest FROM d) AS latest, "
                                     "(SELECT prev FROM pd) AS prev", "L"))
def latest_dates(spark, sf_dir):
    return S.latest_dates(A.long_bars(spark, sf_dir))


@register("top_assets_latest", with_views(
    f"{Q.dates('L')},\n{Q.top_latest('L', 'stock', K_LATEST)}\nSELECT * FROM top", "L"))
def top_assets_latest(spark, sf_dir):
    return S.top_assets(A.long_bars(spark, sf_dir), "stock", K_LATEST, "latest")


@register("top_assets_all", with_views(
    f"{Q.top_all('L', 'stock', K_ALL)}\nSELECT * FROM top", "L"))
def top_assets_all(spark, sf_dir):
    return S.top_assets(A.long_bars(spark, sf_dir), "stock", K_ALL, "all")


@register("top_assets_named", with_views(
    f"{Q.dates('T')},\n{Q.top_latest('T', 'symbol', K_LATEST)}\n"
    "SELECT t.symbol, t.\"count\", n.crypto FROM top t JOIN "
    "(SELECT DISTINCT symbol, crypto FROM T WHERE date = (SELECT latest FROM d)) n "
    "ON t.symbol = n.symbol", "T"))
def top_assets_named(spark, sf_dir):
    return S.top_assets_named(A.tick_bars(spark, sf_dir), "symbol", "crypto", K_LATEST)


# --------------------------------------------------------------------------
# Snapshot change and sparkline (Q1 Q2 Q5 Q6)
# --------------------------------------------------------------------------

def _snapshot_sql(view, key, name, views=None, pre=""):
    return with_views(f"{pre}{Q.snapshot(view, key, name, K_LATEST)}\nSELECT * FROM change", views or view)


def _sparkline_sql(view, key, name, views=None, pre=""):
    return with_views(
        f"{pre}{Q.snapshot(view, key, name, K_LATEST)}\n"
        f"SELECT b.{key}, b.date, b.close, c.color FROM {view} b\n"
        f"JOIN (SELECT DISTINCT {key}, color FROM change) c ON b.{key} = c.{key}\n"
        f"WHERE b.date >= (SELECT latest FROM d) - INTERVAL {SPARK_DAYS} DAY", views or view)


@register("stock_snapshot", _snapshot_sql("L", "stock", "symbol"))
def stock_snapshot(spark, sf_dir):
    return S.snapshot_change(A.long_bars(spark, sf_dir), "stock", "symbol", K_LATEST)


@register("crypto_snapshot", _snapshot_sql("T", "symbol", "crypto"))
def crypto_snapshot(spark, sf_dir):
    return S.snapshot_change(A.tick_bars(spark, sf_dir), "symbol", "crypto", K_LATEST)


@register("stock_sparkline", _sparkline_sql("L", "stock", "symbol"))
def stock_sparkline(spark, sf_dir):
    return S.sparkline(A.long_bars(spark, sf_dir), "stock", "symbol", K_LATEST, SPARK_DAYS)


@register("crypto_sparkline", _sparkline_sql("T", "symbol", "crypto"))
def crypto_sparkline(spark, sf_dir):
    return S.sparkline(A.tick_bars(spark, sf_dir), "symbol", "crypto", K_LATEST, SPARK_DAYS)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The crypto snapshot: scan, aggregate, date subquery, top-k, semi join,
    join of two days, labels.  (At sf0.001 no stock trades on both of the
    last two days, so the stock snapshot is empty there.)"""
    return crypto_snapshot(spark, sf_dir)


# --------------------------------------------------------------------------
# History and open/close comparison (Q3 Q4 Q7 Q8)
# --------------------------------------------------------------------------

HISTORY_SPAN = "1M"
HISTORY_DAYS = 30
COMPARE_DAYS = 7


def _history_sql(view, key, days=HISTORY_DAYS, chosen="true", views=None, pre=""):
    return with_views(f"""{pre}{Q.dates(view)},
r AS (SELECT {key}, date, open, high, low, close, volume FROM {view}
      WHERE date > (SELECT latest FROM d) - INTERVAL {days} DAY AND {chosen}),
s AS (SELECT {key}, count(*) AS n, min({{'d': date, 'o': open, 'h': high, 'l': low, 'c': close, 'v': volume}}).c AS f,
             max({{'d': date, 'o': open, 'h': high, 'l': low, 'c': close, 'v': volume}}).c AS l
      FROM r GROUP BY {key})
SELECT r.*, CASE WHEN coalesce(s.n > 1 AND s.l >= s.f, false) THEN 'green' ELSE 'gray' END AS color
FROM r JOIN s ON r.{key} = s.{key}""", views or view)


def _open_close_sql(view, key, label, views=None, pre=""):
    return with_views(f"""{pre}{Q.dates(view)},
{Q.top_latest(view, key, K_LATEST)},
r AS (SELECT * FROM {view} WHERE date > (SELECT latest FROM d) - INTERVAL {COMPARE_DAYS} DAY
      AND {key} IN (SELECT {key} FROM top))
SELECT {key}, {label} || ' - Open' AS series, date, open AS price FROM r
UNION ALL
SELECT {key}, {label} || ' - Close' AS series, date, close AS price FROM r""", views or view)


@register("stock_history", _history_sql("L", "stock"))
def stock_history(spark, sf_dir):
    return T_.history(A.long_bars(spark, sf_dir), "stock", HISTORY_SPAN)


@register("crypto_history", _history_sql("T", "symbol"))
def crypto_history(spark, sf_dir):
    return T_.history(A.tick_bars(spark, sf_dir), "symbol", HISTORY_SPAN)


@register("stock_open_close", _open_close_sql("L", "stock", "stock"))
def stock_open_close(spark, sf_dir):
    return T_.open_close(A.long_bars(spark, sf_dir), "stock", "stock", K_LATEST, COMPARE_DAYS)


@register("crypto_open_close", _open_close_sql("T", "symbol", "crypto"))
def crypto_open_close(spark, sf_dir):
    return T_.open_close(A.tick_bars(spark, sf_dir), "symbol", "crypto", K_LATEST, COMPARE_DAYS)


# Every range label, for both bar tables
def _span_history(view, key, span):
    return lambda spark, sf_dir: T_.history(view(spark, sf_dir), key, span)


for _span, _days in RANGE_DAYS.items():
    if _span != HISTORY_SPAN:
        register(f"stock_history_{_span.lower()}", _history_sql("L", "stock", _days))(_span_history(A.long_bars, "stock", _span))
        register(f"crypto_history_{_span.lower()}", _history_sql("T", "symbol", _days))(_span_history(A.tick_bars, "symbol", _span))

# Chosen assets: by key, and by display name looked up on the latest day
CHOSEN_TYPES, CHOSEN_STOCKS = ["click", "view"], ["Stock Brand#1", "Stock Brand#12", "Stock Brand#9"]


@register("crypto_history_chosen", _history_sql("T", "symbol", chosen=f"symbol IN {tuple(CHOSEN_TYPES)}"))
def crypto_history_chosen(spark, sf_dir):
    return T_.history(A.tick_bars(spark, sf_dir), "symbol", HISTORY_SPAN, assets=CHOSEN_TYPES)


@register("stock_history_named", _history_sql(
    "L", "symbol", chosen=f"""symbol IN (SELECT max(symbol) FROM L WHERE date = (SELECT latest FROM d)
      AND stock IN {tuple(CHOSEN_STOCKS)} GROUP BY stock)"""))
def stock_history_named(spark, sf_dir):
    return T_.history(A.long_bars(spark, sf_dir), "symbol", HISTORY_SPAN, assets=CHOSEN_STOCKS, by_name="stock")


# Missing numbers: NaN closes and zero previous closes
_HOLED = ("CASE WHEN date = (SELECT max(date) FROM L) AND symbol LIKE '%1' THEN {nan} "
          "WHEN date < (SELECT max(date) FROM L) AND symbol LIKE '%2' THEN 0.0 ELSE close END")


@register("snapshot_missing", _snapshot_sql(
    "H", "stock", "symbol", "L", f"H AS (SELECT symbol, stock, date, open, {_HOLED.format(nan='NULL')} AS close FROM L),\n"))
def snapshot_missing(spark, sf_dir):
    bars = A.long_bars(spark, sf_dir)
    latest = S.latest_date(bars)
    close = (F.when((F.col("date") == latest) & F.col("symbol").like("%1"), F.lit(float("nan")))
             .when((F.col("date") < latest) & F.col("symbol").like("%2"), F.lit(0.0)).otherwise(F.col("close")))
    return S.snapshot_change(bars.withColumn("close", close), "stock", "symbol", K_LATEST)


# --------------------------------------------------------------------------
# Calendar columns, value lists, indicator views
# --------------------------------------------------------------------------

YOY_YEARS = (1998, 1999)
ROLL_WINDOW = 3

_CAL_SQL = ("CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
            "strftime(date, '%b') AS month_name")


@register("calendar_columns", with_views(
    f"SELECT symbol, date, {_CAL_SQL}, CAST(date_trunc('month', date) AS DATE) AS year_month FROM L",
    "L"))
def calendar_columns(spark, sf_dir):
    return I_.calendar_columns(A.long_bars(spark, sf_dir)).select(
        "symbol", "date", "year", "month", "month_name", "year_month")


@register("asset_list", with_views("SELECT DISTINCT stock FROM L WHERE stock IS NOT NULL", "L"))
def asset_list(spark, sf_dir):
    return I_.sorted_values(A.long_bars(spark, sf_dir), "stock")


@register("indicator_list", with_views(
    "SELECT DISTINCT indicator FROM N WHERE indicator IS NOT NULL", "N"))
def indicator_list(spark, sf_dir):
    return I_.sorted_values(A.indicators(spark, sf_dir), "indicator")


@register("indicator_years", with_views(
    "SELECT DISTINCT CAST(year(date) AS INTEGER) AS year FROM N WHERE date IS NOT NULL", "N"))
def indicator_years(spark, sf_dir):
    return I_.sorted_values(I_.calendar_columns(A.indicators(spark, sf_dir)), "year")


@register("indicator_yoy", with_views(
    f"SELECT indicator, CAST(year(date) AS VARCHAR) AS legend, {_CAL_SQL}, date, value FROM N "
    f"WHERE year(date) IN {tuple(YOY_YEARS)}", "N"))
def indicator_yoy(spark, sf_dir):
    return I_.yoy(A.indicators(spark, sf_dir), None, YOY_YEARS)


def _rolling_sql(w):
    terms = [f"lag(value, {d}) OVER o" for d in range(w - 1, 0, -1)] + ["value"]
    total = terms[0]
    for t in terms[1:]:
        total = f"({total} + {t})"
    return with_views(f"SELECT indicator, date, value, {total} / {float(w)} AS rolling_avg FROM N "
                      f"WHERE indicator IS NOT NULL "
                      f"WINDOW o AS (PARTITION BY indicator ORDER BY date, value)", "N")


@register("indicator_rolling", _rolling_sql(ROLL_WINDOW))
def indicator_rolling(spark, sf_dir):
    return I_.rolling_mean(A.indicators(spark, sf_dir), None, ROLL_WINDOW)


WIDE_WINDOW = 200


def _wide_sql(w):
    return with_views(f"""SELECT stock, date, close, CASE WHEN count(*) OVER o = {w} AND count(close) OVER o = {w}
  THEN CAST(sum(CAST(round(close * 10000.0) AS HUGEINT)) OVER o AS DOUBLE) / {w * 10.0 ** 4} END AS rolling_avg
FROM L WHERE stock IS NOT NULL
WINDOW o AS (PARTITION BY stock ORDER BY date, close ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)""", "L")


@register("close_rolling", _wide_sql(ROLL_WINDOW))
def close_rolling(spark, sf_dir):
    return I_.rolling_mean_exact(A.long_bars(spark, sf_dir), None, ROLL_WINDOW, "stock", "date", "close")


@register("close_rolling_wide", _wide_sql(WIDE_WINDOW))
def close_rolling_wide(spark, sf_dir):
    """E1 over a width that no list of lags would hold: same plan as the narrow one."""
    return I_.rolling_mean_exact(A.long_bars(spark, sf_dir), None, WIDE_WINDOW, "stock", "date", "close")


# --------------------------------------------------------------------------
# Movers (Q11 B7 H3 H4)
# --------------------------------------------------------------------------

K_MOVERS = 10


@register("coerce_numbers", with_views(f"{Q.movers_clean('M')}\nSELECT * FROM mc", "M"))
def coerce_numbers(spark, sf_dir):
    return M_.clean_movers(A.movers_text(spark, sf_dir))


@register("movers_top", with_views(
    f"{Q.movers_clean('M')}\nSELECT *, printf('%.2f%%', change_percentage) AS change_percentage_display "
    f"FROM mc ORDER BY change_amount DESC, ticker LIMIT {K_MOVERS}", "M"))
def movers_top(spark, sf_dir):
    return M_.top_movers(M_.clean_movers(A.movers_text(spark, sf_dir)), K_MOVERS)


# --------------------------------------------------------------------------
# Ingest: land CSV, scan, name, type, publish, read back
# --------------------------------------------------------------------------

# The test views predate the landing floor of the live feeds, so the
# registered curation runs use a floor inside their date range.
TEST_FLOOR = "1998-01-01"


def _curated(spark, bars, dataset, floor, code_col=None):
    from finseries.session import remove_path, scratch_path
    from finseries.sources import raw as R
    from finseries.sources import store as ST
    landing = R.land_csv(bars, scratch_path(spark, "landing", dataset), dataset, code_col)
    table = scratch_path(spark, "curated", dataset)
    dated = "date" in R.RAW_COLUMNS[dataset]
    ST.publish(R.curate(spark, landing, dataset, floor=floor), table, sort_within=["date"] if dated else None, dates="date" if dated else None)
    remove_path(spark, landing)
    rows, known = ST.read_curated(spark, table), ST.run_dates(spark, table)
    return S.know_dates(rows, *known[1:]) if known else rows


def _case(col, names):
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in names.items())
    return f"CASE {col} {whens} ELSE 'Unknown' END"


@register("raw_csv_roundtrip", with_views(
    "SELECT symbol, date, open, high, low, close, volume FROM T", "T"))
def raw_csv_roundtrip(spark, sf_dir):
    from finseries.session import scratch_path
    from finseries.sources import raw as R
    landing = R.land_csv(A.tick_bars(spark, sf_dir), scratch_path(spark, "landing", "crypto"), "crypto")
    raw = R.read_raw(spark, landing, "crypto")
    return R.typed(raw, "crypto", floor=None).select(
        "symbol", "date", "open", "high", "low", "close", "volume")


@register("curate_stocks", with_views(
    f"SELECT symbol, {_case('symbol', STOCK_NAMES)} AS stock, date, open, high, low, close, volume "
    f"FROM L WHERE date > DATE '{TEST_FLOOR}'", "L"))
def curate_stocks(spark, sf_dir):
    return _curated(spark, A.long_bars(spark, sf_dir), "stocks", TEST_FLOOR)


@register("curate_crypto", with_views(
    f"SELECT symbol, {_case('symbol', CRYPTO_NAMES)} AS crypto, date, open, high, low, close, volume "
    f"FROM T", "T"))
def curate_crypto(spark, sf_dir):
    return _curated(spark, A.tick_bars(spark, sf_dir), "crypto", None)


@register("curate_indicators", with_views(
    f"SELECT {_case('indicator', INDICATOR_NAMES)} AS indicator, date, value FROM N "
    f"WHERE date >= DATE '{TEST_FLOOR}'", "N"))
def curate_indicators(spark, sf_dir):
    src = A.indicators(spark, sf_dir).withColumnRenamed("indicator", "code")
    return _curated(spark, src, "economic_indicators", TEST_FLOOR)


@register("curate_commodities", with_views(
    f"SELECT indicator AS commodity, date, value FROM N WHERE date > DATE '{TEST_FLOOR}'", "N"))
def curate_commodities(spark, sf_dir):
    src = A.indicators(spark, sf_dir).withColumnRenamed("indicator", "commodity")
    return _curated(spark, src, "commodities", TEST_FLOOR)


@register("curate_movers", with_views(
    f"{Q.movers_clean('M')}\nSELECT * FROM mt", "M"))
def curate_movers(spark, sf_dir):
    return _curated(spark, A.movers_text(spark, sf_dir), "top_gainers", None)


# --------------------------------------------------------------------------
# Forecasts
# --------------------------------------------------------------------------

HORIZON, SHOW_LAST = 15, 30
MIN_POINTS, LAST_POINTS = 30, 120
FC_DIGITS, Y_DIGITS = 6, 10


def _training_sql(view, key):
    return with_views(f"{Q.training(view, key, MIN_POINTS, LAST_POINTS)}\n"
                      f"SELECT {key}, ds, round(y, {Y_DIGITS}) AS y FROM tr", view)


@register("training_set", _training_sql("T", "symbol"))
def training_set(spark, sf_dir):
    tr = FC.training_set(A.tick_bars(spark, sf_dir), "symbol", MIN_POINTS, LAST_POINTS)
    return tr.select("symbol", "ds", F.round("y", Y_DIGITS).alias("y"))


@register("stock_training_set", _training_sql("L", "stock"))
def stock_training_set(spark, sf_dir):
    tr = FC.training_set(A.long_bars(spark, sf_dir), "stock", MIN_POINTS, LAST_POINTS)
    return tr.select("stock", "ds", F.round("y", Y_DIGITS).alias("y"))


def _season_join(rel):
    return f"LEFT JOIN dow ON dow.symbol = {rel}.symbol AND dow.dw = dayofweek({rel}.date)"


def _staged_training(spark, bars, key):
    from finseries.sources.store import stage
    return stage(FC.training_set(bars, key, MIN_POINTS, LAST_POINTS), "training")


@register("forecast_baseline", with_views(f"""{Q.training('T', 'symbol', MIN_POINTS, LAST_POINTS)},
{Q.baseline('symbol', HORIZON)}
SELECT fut.symbol, fut.date, round(exp(fut.a + fut.b * fut.x + coalesce(dow.s, 0)), {FC_DIGITS}) AS forecast
FROM fut {_season_join('fut')}""", "T"))
def forecast_baseline(spark, sf_dir):
    tr = _staged_training(spark, A.tick_bars(spark, sf_dir), "symbol")
    return FC.forecast_baseline(tr, "symbol", HORIZON, digits=FC_DIGITS)


@register("forecast_combined_baseline", with_views(f"""{Q.training('T', 'symbol', MIN_POINTS, LAST_POINTS)},
{Q.baseline('symbol', HORIZON)},
rows AS (SELECT symbol, ds AS date, x, a, b, last_ds FROM xr
         UNION ALL SELECT symbol, date, x, a, b, last_ds FROM fut),
pr AS (SELECT rows.*, rows.a + rows.b * rows.x + coalesce(dow.s, 0) AS pred FROM rows {_season_join('rows')}),
hs AS (SELECT xr.symbol, xr.y - (xr.a + xr.b * xr.x + coalesce(dow.s, 0)) AS e
       FROM (SELECT xr.*, xr.ds AS date FROM xr) xr {_season_join('xr')}),
sd AS (SELECT symbol, stddev_samp(e) AS sd FROM hs GROUP BY symbol),
act AS (SELECT symbol, ds, y, row_number() OVER (PARTITION BY symbol ORDER BY ds DESC) AS rn FROM tr)
SELECT symbol, ds AS date, round(exp(y), {FC_DIGITS}) AS value, 'Actual' AS Type,
       CAST(NULL AS DOUBLE) AS lower_ci, CAST(NULL AS DOUBLE) AS upper_ci FROM act WHERE rn <= {SHOW_LAST}
UNION ALL
SELECT pr.symbol, pr.date, round(exp(pred), {FC_DIGITS}) AS value,
       CASE WHEN pr.date > pr.last_ds THEN 'Forecast' ELSE 'Fitted' END AS Type,
       round(exp(pred - {FC.Z80} * coalesce(sd.sd, 0)), {FC_DIGITS}) AS lower_ci,
       round(exp(pred + {FC.Z80} * coalesce(sd.sd, 0)), {FC_DIGITS}) AS upper_ci
FROM pr LEFT JOIN sd ON pr.symbol = sd.symbol""", "T"))
def forecast_combined_baseline(spark, sf_dir):
    tr = _staged_training(spark, A.tick_bars(spark, sf_dir), "symbol")
    fc = FC.forecast_baseline(tr, "symbol", HORIZON, with_fitted=True, digits=FC_DIGITS)
    return FC.combined(tr, fc, "symbol", SHOW_LAST, digits=FC_DIGITS)


def _exact_part_sql(view, key, pre=""):
    """Rows of the combined additive forecast with what SQL can tell: dates, types, actual values, row counts."""
    return with_views(f"""{pre}{Q.training(view, key, MIN_POINTS, LAST_POINTS)},
lst AS (SELECT {key}, max(ds) AS last_ds FROM tr GROUP BY {key}),
act AS (SELECT {key}, ds, y, row_number() OVER (PARTITION BY {key} ORDER BY ds DESC) AS rn FROM tr)
SELECT {key}, ds AS date, 'Actual' AS Type, round(exp(y), {FC_DIGITS}) AS actual, CAST(NULL AS BOOLEAN) AS in_band
FROM act WHERE rn <= {SHOW_LAST}
UNION ALL SELECT {key}, ds, 'Fitted', NULL, true FROM tr
UNION ALL SELECT {key}, CAST(last_ds + h * INTERVAL 1 DAY AS DATE), 'Forecast', NULL, true
FROM (SELECT {key}, last_ds, unnest(generate_series(1, {HORIZON})) AS h FROM lst)""", "L" if view != "T" else "T")


def _exact_part(train, key):
    rows = FC.combined(train, FC.forecast_additive(train, key, HORIZON), key, SHOW_LAST)
    actual = F.col("Type") == FC.ACTUAL
    return rows.select(
        key, "date", "Type", F.when(actual, F.round("value", FC_DIGITS)).alias("actual"),
        F.when(~actual, F.coalesce((F.col("lower_ci") <= F.col("value")) & (F.col("value") <= F.col("upper_ci")), F.lit(False))).alias("in_band"))


@register("forecast_additive", _exact_part_sql("T", "symbol"))
def forecast_additive(spark, sf_dir):
    """The additive forecast; model values are checked against their band, as SQL cannot compute them
    (their error is judged by ``forecast_backtest``)."""
    return _exact_part(_staged_training(spark, A.tick_bars(spark, sf_dir), "symbol"), "symbol")


def _top_bars(spark, sf_dir):
    bars = A.long_bars(spark, sf_dir)
    top = F.broadcast(S.top_assets(bars, "stock", K_ALL, "all").select("stock"))
    return bars.join(top, "stock", "left_semi")


_TOP_BARS = f"{Q.top_all('L', 'stock', K_ALL)},\nB AS (SELECT * FROM L WHERE stock IN (SELECT stock FROM top)),\n"


@register("stock_forecast", _exact_part_sql("B", "stock", _TOP_BARS))
def stock_forecast(spark, sf_dir):
    """Q12: the additive forecast for the 20 assets with the most rows."""
    return _exact_part(_staged_training(spark, _top_bars(spark, sf_dir), "stock"), "stock")


@register("forecast_fit_check", with_views(
    f"{Q.training('L', 'stock', MIN_POINTS, LAST_POINTS)}\n"
    "SELECT stock, count(*) AS n_points, true AS converged FROM tr GROUP BY stock", "L"))
def forecast_fit_check(spark, sf_dir):
    """Every asset's fit passes the first-order optimality test."""
    tr = _staged_training(spark, A.long_bars(spark, sf_dir), "stock")
    fits = FC.forecast_additive(tr, "stock", HORIZON).where(F.col("Type") == FC.FITTED)
    return fits.groupBy("stock").agg(F.count("*").alias("n_points"), F.every("converged").alias("converged"))


FOLDS = 3

_BACKTEST = with_views(f"""{Q.training('L', 'stock', MIN_POINTS, LAST_POINTS)},
f AS (SELECT stock, ds, y, fold, max(ds) OVER (PARTITION BY stock) AS last FROM tr, (SELECT unnest(range(1, {FOLDS + 1})) AS fold)),
o AS (SELECT *, max(CASE WHEN ds <= last - CAST(fold * {HORIZON} AS INTEGER) THEN ds END) OVER (PARTITION BY stock, fold) AS origin FROM f),
k AS (SELECT *, ds > origin AS held, count(*) FILTER (ds <= origin) OVER w AS n, count(*) FILTER (ds > origin AND ds <= origin + {HORIZON}) OVER w AS h
      FROM o WINDOW w AS (PARTITION BY stock, fold)),
p AS (SELECT *, CAST(date_diff('day', origin, ds) AS DOUBLE) AS x FROM k WHERE ds <= origin + {HORIZON} AND n >= {MIN_POINTS} AND h > 0),
fit AS (SELECT stock, fold, regr_intercept(y, x) AS a, regr_slope(y, x) AS b FROM p WHERE NOT held GROUP BY ALL),
r AS (SELECT p.*, a, b, y - (a + b * x) AS e FROM p JOIN fit USING (stock, fold)),
dow AS (SELECT stock, fold, dayofweek(ds) AS dw, avg(e) AS s FROM r WHERE NOT held GROUP BY ALL),
q AS (SELECT r.*, a + b * x + coalesce(s, 0) AS pred FROM r LEFT JOIN dow ON dow.stock = r.stock AND dow.fold = r.fold AND dow.dw = dayofweek(r.ds)),
sd AS (SELECT stock, fold, coalesce(stddev_samp(y - pred), 0) AS sd FROM q WHERE NOT held GROUP BY ALL)
SELECT stock, count(DISTINCT fold) AS n_folds, count(*) AS n_held, round(avg(abs(exp(pred) - exp(y)) / exp(y)), {FC_DIGITS}) AS baseline_error,
       round(avg(CASE WHEN exp(pred - {FC.Z80} * sd) <= exp(y) AND exp(y) <= exp(pred + {FC.Z80} * sd) THEN 1.0 ELSE 0.0 END), {FC_DIGITS}) AS baseline_inside,
       true AS model_calibrated
FROM q JOIN sd USING (stock, fold) WHERE held GROUP BY stock""", "L")


def _backtest(spark, sf_dir):
    return BT.backtest(_staged_training(spark, A.long_bars(spark, sf_dir), "stock"), "stock", FOLDS, HORIZON, MIN_POINTS)


@register("forecast_backtest", _BACKTEST)
def forecast_backtest(spark, sf_dir):
    """Rolling-origin errors and band coverage.  The baseline's are exact; the model, which SQL cannot
    compute, counts as calibrated if its 80 % bands hold 70 to 90 % of all held-out days."""
    from finseries.sources.store import stage
    found = stage(_backtest(spark, sf_dir), "backtest")
    inside = found.agg(F.sum(F.col("model_inside") * F.col("n_held")) / F.sum("n_held")).scalar()
    return found.select("stock", "n_folds", "n_held", F.round("baseline_error", FC_DIGITS).alias("baseline_error"),
                        F.round("baseline_inside", FC_DIGITS).alias("baseline_inside"), inside.between(0.7, 0.9).alias("model_calibrated"))


@register("forecast_backtest_model")
def forecast_backtest_model(spark, sf_dir):
    """The model's own rolling-origin error and band coverage beside the baseline's (no SQL twin)."""
    return _backtest(spark, sf_dir)


@register("forecast_band", ORACLE["forecast_combined_baseline"].replace(
    "SELECT symbol, ds AS date, round(exp(y)", "SELECT * FROM (SELECT symbol, ds AS date, round(exp(y)") + ") WHERE Type = 'Forecast'")
def forecast_band(spark, sf_dir):
    """The forecast rows of the combined output."""
    return FC.band(forecast_combined_baseline(spark, sf_dir))


# --------------------------------------------------------------------------
# The vendor's landing layout: one <code>.csv per asset, real codes and names
# --------------------------------------------------------------------------

_INDICATOR_OF = {"F": "treasury", "O": "federal", "P": "cpi"}


def _vendor_crypto(spark, sf_dir):
    """Tick bars under the ten crypto codes: two codes per event type, by day parity."""
    t = A.tick_bars(spark, sf_dir)
    types = ["click", "error", "purchase", "signup", "view"]
    at = (F.array_position(F.array(*map(F.lit, types)), F.col("symbol")) - 1) * 2 + F.dayofmonth("date") % 2 + 1
    return t.withColumn("symbol", F.element_at(F.array(*map(F.lit, CRYPTO_CODES)), at.cast("int")))


_VENDOR_CRYPTO = f"""V AS (SELECT {CRYPTO_CODES}[(list_position(['click', 'error', 'purchase', 'signup', 'view'], symbol) - 1) * 2
       + CAST(day(date) AS INTEGER) % 2 + 1] AS symbol, date, open, high, low, close, volume FROM T)"""


def _vendor_stocks(spark, sf_dir):
    n = F.substring("symbol", 7, 9).cast("int")
    return A.long_bars(spark, sf_dir).withColumn("symbol", F.element_at(F.array(*map(F.lit, STOCK_CODES)), (n - 1) % len(STOCK_CODES) + 1))


_VENDOR_STOCKS = f"""V AS (SELECT {STOCK_CODES}[(CAST(substr(symbol, 7) AS INTEGER) - 1) % {len(STOCK_CODES)} + 1] AS symbol,
       date, open, high, low, close, volume FROM L)"""


def _vendor(spark, df, dataset, floor, code_col=None, **how):
    """Land <code>.csv files and curate them as the vendor layout."""
    from finseries.session import scratch_path
    from finseries.sources import raw as R
    landing = R.land_files(df, scratch_path(spark, "landing", dataset), dataset, code_col, how.get("header", True), how.pop("columns", None))
    return R.curate(spark, landing, dataset, "files", floor=floor, **how)


def _named_sql(pre, name, names, where, view):
    return with_views(f"{pre}\nSELECT symbol, {_case('symbol', names)} AS {name}, date, open, high, low, close, volume "
                      f"FROM V WHERE {where}", view)


@register("vendor_crypto", _named_sql(_VENDOR_CRYPTO, "crypto", CRYPTO_NAMES, "true", "T"))
def vendor_crypto(spark, sf_dir):
    return _vendor(spark, _vendor_crypto(spark, sf_dir), "crypto", None)


@register("vendor_stocks", _named_sql(_VENDOR_STOCKS, "stock", STOCK_NAMES, f"date > DATE '{TEST_FLOOR}'", "L"))
def vendor_stocks(spark, sf_dir):
    return _vendor(spark, _vendor_stocks(spark, sf_dir), "stocks", TEST_FLOOR)


@register("vendor_indicators", with_views(
    f"SELECT {_case('indicator', {k: INDICATOR_NAMES[v] for k, v in _INDICATOR_OF.items()})} AS indicator, date, value FROM N "
    f"WHERE date >= DATE '{TEST_FLOOR}'", "N"))
def vendor_indicators(spark, sf_dir):
    pairs = [F.lit(x) for kv in _INDICATOR_OF.items() for x in kv]
    src = A.indicators(spark, sf_dir).withColumn("code", F.create_map(*pairs)[F.col("indicator")])
    return _vendor(spark, src, "economic_indicators", TEST_FLOOR)


@register("vendor_no_header", ORACLE["vendor_crypto"])
def vendor_no_header(spark, sf_dir):
    return _vendor(spark, _vendor_crypto(spark, sf_dir), "crypto", None, header=False)


@register("vendor_by_name", ORACLE["vendor_crypto"])
def vendor_by_name(spark, sf_dir):
    """Files whose columns come in another order, mapped by header name."""
    return _vendor(spark, _vendor_crypto(spark, sf_dir), "crypto", None, by_name=True,
                   columns=["volume", "close", "date", "high", "low", "open"])


@register("publish_two_runs", ORACLE["vendor_crypto"])
def publish_two_runs(spark, sf_dir):
    """A first run with half of the columns' values missing, then the real one as a single file; the first is pruned."""
    from finseries.session import scratch_path
    from finseries.sources import store as ST
    rows = ST.stage(_vendor(spark, _vendor_crypto(spark, sf_dir), "crypto", None), "vendor")
    table = scratch_path(spark, "curated", "crypto")
    ST.publish(rows.withColumn("close", F.lit(None).cast("double")), table)
    ST.publish(rows, table, single_file=True, keep=1)
    return ST.read_curated(spark, table)


# --------------------------------------------------------------------------
# Bar questions on a published table, whose rows are sorted by date (Q1-Q4)
# --------------------------------------------------------------------------

_PUBLISHED = (f"P AS (SELECT symbol, {_case('symbol', STOCK_NAMES)} AS stock, date, open, high, low, close, volume "
              f"FROM L WHERE date > DATE '{TEST_FLOOR}'),\n")


@register("published_snapshot", _snapshot_sql("P", "symbol", "stock", "L", _PUBLISHED))
def published_snapshot(spark, sf_dir):
    return S.snapshot_change(curate_stocks(spark, sf_dir), "symbol", "stock", K_LATEST)


@register("published_sparkline", _sparkline_sql("P", "symbol", "stock", "L", _PUBLISHED))
def published_sparkline(spark, sf_dir):
    return S.sparkline(curate_stocks(spark, sf_dir), "symbol", "stock", K_LATEST, SPARK_DAYS)


@register("published_history", _history_sql("P", "symbol", views="L", pre=_PUBLISHED))
def published_history(spark, sf_dir):
    return T_.history(curate_stocks(spark, sf_dir), "symbol", HISTORY_SPAN)


@register("published_open_close", _open_close_sql("P", "symbol", "symbol", "L", _PUBLISHED))
def published_open_close(spark, sf_dir):
    return T_.open_close(curate_stocks(spark, sf_dir), "symbol", "symbol", K_LATEST, COMPARE_DAYS)


@register("stream_curate_crypto", ORACLE["curate_crypto"])
def stream_curate_crypto(spark, sf_dir):
    """Curation triggered by changed files."""
    from finseries.session import scratch_path
    from finseries.sources import raw as R
    from finseries.sources import store as ST
    from finseries.streaming.ingest import republish_on_arrival
    landing = R.land_csv(A.tick_bars(spark, sf_dir), scratch_path(spark, "landing", "crypto"), "crypto")
    table = scratch_path(spark, "curated", "crypto")
    republish_on_arrival(spark, landing, "crypto", table, floor=None)
    return ST.read_curated(spark, table)


@register("watch_overwritten", _named_sql(
    f"{_VENDOR_CRYPTO[:-len(' FROM T)')]} FROM (SELECT symbol, date, open, high, low, CASE WHEN symbol = 'click' THEN close + 1 ELSE close END AS close, volume FROM T))",
    "crypto", CRYPTO_NAMES, "true", "T"))
def watch_overwritten(spark, sf_dir):
    """A second drop overwrites the files of one event type in place; only their codes are curated again."""
    from finseries.session import scratch_path
    from finseries.sources import raw as R
    from finseries.sources import store as ST
    from finseries.streaming.ingest import republish_on_arrival
    bars = _vendor_crypto(spark, sf_dir)
    landing, table = scratch_path(spark, "landing", "crypto"), scratch_path(spark, "curated", "crypto")
    R.land_files(bars, landing, "crypto")
    republish_on_arrival(spark, landing, "crypto", table, layout="files", floor=None)
    again = bars.where(F.col("symbol").isin(CRYPTO_CODES[:2])).withColumn("close", F.col("close") + 1)
    R.land_files(again, landing, "crypto")
    republish_on_arrival(spark, landing, "crypto", table, layout="files", floor=None)
    return ST.read_curated(spark, table)
