"""DuckDB SQL building blocks for the oracle twins of the registered queries."""

from __future__ import annotations

UP, DOWN = "▲", "▼"


def rises(curr: str, prev: str) -> str:
    return (f"coalesce(CASE WHEN {prev} = 0 THEN NULL ELSE ({curr} - {prev}) / {prev} * 100 END > 0 "
            f"OR ({prev} = 0 AND {curr} > 0), false)")


def pct(curr: str, prev: str) -> str:
    return f"CASE WHEN {prev} = 0 THEN NULL ELSE ({curr} - {prev}) / {prev} * 100 END"


def dates(view: str) -> str:
    return (f"d AS (SELECT max(date) AS latest FROM {view}),\n"
            f"pd AS (SELECT max(date) AS prev FROM {view} WHERE date < (SELECT latest FROM d))")


def top_latest(view: str, key: str, k: int) -> str:
    return (f"top AS (SELECT {key}, count(*) AS \"count\" FROM {view}\n"
            f"  WHERE date = (SELECT latest FROM d) AND {key} IS NOT NULL\n"
            f"  GROUP BY {key} ORDER BY \"count\" DESC, {key} LIMIT {k})")


def top_all(view: str, key: str, k: int) -> str:
    return (f"top AS (SELECT {key}, count(*) AS \"count\" FROM {view}\n"
            f"  WHERE {key} IS NOT NULL GROUP BY {key} ORDER BY \"count\" DESC, {key} LIMIT {k})")


def snapshot(view: str, key: str, name: str, k: int) -> str:
    """CTEs d, pd, top, change (the snapshot change table)."""
    return f"""{dates(view)},
{top_latest(view, key, k)},
cur AS (SELECT * FROM {view} WHERE date = (SELECT latest FROM d) AND {key} IN (SELECT {key} FROM top)),
prv AS (SELECT {key}, avg(close) AS close FROM {view}
        WHERE date = (SELECT prev FROM pd) AND {key} IN (SELECT {key} FROM top) GROUP BY {key}),
snap AS (SELECT c.{key}, c.{name}, c.open AS open_curr, c.close AS close_curr, p.close AS close_prev
         FROM cur c JOIN prv p ON c.{key} = p.{key}),
change AS (SELECT {key}, {name}, open_curr, close_curr, close_prev,
  {pct('close_curr', 'close_prev')} AS pct_change,
  CASE WHEN {rises('close_curr', 'close_prev')} THEN '{UP}' ELSE '{DOWN}' END AS arrow,
  CASE WHEN {rises('close_curr', 'close_prev')} THEN 'green' ELSE 'red' END AS color
  FROM snap)"""


NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INF_RE = r"^\s*[+-]?(inf|infinity)\s*$"


def number(col: str) -> str:
    """Lenient text-to-double with the same accepted forms as ``to_number``."""
    return (f"CASE WHEN regexp_matches({col}, '{NUMBER_RE}') "
            f"OR regexp_matches(lower({col}), '{INF_RE}') "
            f"THEN TRY_CAST(trim({col}) AS DOUBLE) END")


def movers_clean(view: str) -> str:
    """CTE ``mc``: typed movers with incomplete rows dropped."""
    return f"""mt AS (SELECT ticker, {number('price')} AS price, {number('change_amount')} AS change_amount,
  {number("replace(change_percentage, '%', '')")} AS change_percentage, {number('volume')} AS volume
  FROM {view}),
mc AS (SELECT * FROM mt WHERE price IS NOT NULL AND change_amount IS NOT NULL
  AND change_percentage IS NOT NULL AND volume IS NOT NULL)"""


def training(view: str, key: str, min_points: int, last: int) -> str:
    """CTE ``tr``: key, ds, y (log of the daily mean close), gated and cut."""
    return f"""m AS (SELECT {key}, date AS ds, avg(close) AS p FROM {view}
  WHERE date IS NOT NULL AND close IS NOT NULL GROUP BY 1, 2),
g AS (SELECT {key} FROM m GROUP BY {key} HAVING count(*) >= {min_points}),
rk AS (SELECT m.*, row_number() OVER (PARTITION BY {key} ORDER BY ds DESC) AS rn
  FROM m WHERE {key} IN (SELECT {key} FROM g)),
tr AS (SELECT {key}, ds, ln(p) AS y FROM rk WHERE rn <= {last} AND p > 0)"""


def baseline(key: str, horizon: int) -> str:
    """CTEs over ``tr``: lst, x, fit, xr, dow, fut (the baseline model)."""
    return f"""lst AS (SELECT {key}, max(ds) AS last_ds FROM tr GROUP BY {key}),
x AS (SELECT tr.{key}, tr.ds, tr.y, lst.last_ds, CAST(date_diff('day', lst.last_ds, tr.ds) AS DOUBLE) AS x
  FROM tr JOIN lst ON tr.{key} = lst.{key}),
fit AS (SELECT {key}, max(last_ds) AS last_ds, regr_intercept(y, x) AS a, regr_slope(y, x) AS b
  FROM x GROUP BY {key}),
xr AS (SELECT x.*, fit.a, fit.b, x.y - (fit.a + fit.b * x.x) AS r FROM x JOIN fit ON x.{key} = fit.{key}),
dow AS (SELECT {key}, dayofweek(ds) AS dw, avg(r) AS s FROM xr GROUP BY 1, 2),
fh AS (SELECT {key}, last_ds, a, b, unnest(generate_series(1, {horizon})) AS h FROM fit),
fut AS (SELECT {key}, last_ds, a, b, CAST(last_ds + h * INTERVAL 1 DAY AS DATE) AS date, CAST(h AS DOUBLE) AS x
  FROM fh)"""
