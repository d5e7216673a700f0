"""Label and display expressions: arrows, colors, percent text, series names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from finseries.functions.parse import nan_to_null

# Fixed values of the labels.
UP_ARROW, DOWN_ARROW = "▲", "▼"
GREEN, RED, GRAY = "green", "red", "gray"
OPEN_SUFFIX, CLOSE_SUFFIX = "Open", "Close"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(c) -> Column:
    return nan_to_null(_col(c).cast("double"))


def pct_change(curr, prev) -> Column:
    """``(curr - prev) / prev * 100``; NULL when prev is zero or either is missing (NULL or NaN)."""
    curr, prev = _number(curr), _number(prev)
    return F.try_divide(curr - prev, prev) * F.lit(100.0)


def rises(curr, prev) -> Column:
    """True when the change is positive, counting a rise from zero as positive.

    Zero change, a missing value or a fall are all "not rising".
    """
    curr, prev = _number(curr), _number(prev)
    pct = pct_change(curr, prev)
    return F.coalesce((pct > 0) | ((prev == 0) & (curr > 0)), F.lit(False))


def arrow(curr, prev) -> Column:
    return F.when(rises(curr, prev), F.lit(UP_ARROW)).otherwise(F.lit(DOWN_ARROW))


def change_color(curr, prev) -> Column:
    return F.when(rises(curr, prev), F.lit(GREEN)).otherwise(F.lit(RED))


def trend_color(n_rows, first_close, last_close) -> Column:
    """Green when there is more than one row and the last close is not below the first."""
    ok = (_col(n_rows) > 1) & (_number(last_close) >= _number(first_close))
    return F.when(F.coalesce(ok, F.lit(False)), F.lit(GREEN)).otherwise(F.lit(GRAY))


def percent_text(c) -> Column:
    """Two decimals and a percent sign; NULL stays NULL."""
    c = _col(c)
    return F.when(c.isNotNull(), F.format_string("%.2f%%", c))


def series_name(name, kind) -> Column:
    return F.concat_ws(" - ", _col(name), _col(kind))
