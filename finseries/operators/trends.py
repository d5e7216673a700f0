"""Range history with trend color, and the open/close comparison in long form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finseries.functions import labels
from finseries.functions.parse import numbers
from finseries.operators.snapshot import days_before_latest, latest_date, top_assets, year_start_of_latest
from finseries.schemas import RANGE_DAYS


CALENDAR_YTD = "calendar_ytd"


def span_days(span) -> int:
    """A range label ("5D", "1M", "6M", "YTD", "1Y", "5Y") or a day count.

    "YTD" is a fixed 90 days; ``CALENDAR_YTD`` (not a day count) means
    since January 1 of the latest date's year.
    """
    if isinstance(span, str):
        try:
            return RANGE_DAYS[span]
        except KeyError:
            raise ValueError(f"unknown range {span!r}; one of {sorted(RANGE_DAYS)}") from None
    return int(span)


def keys_for_names(bars: DataFrame, key: str, name: str, names: Iterable[str],
                   date_col: str = "date") -> DataFrame:
    """Codes of the chosen display names, looked up on the latest day.

    One code per name: if a name has several codes on that day the greatest
    code is taken.  The result has at most ``len(names)`` rows.
    """
    wanted = list(names)
    day = bars.where((F.col(date_col) == latest_date(bars, date_col)) & F.col(name).isin(wanted))
    return day.groupBy(name).agg(F.max(key).alias(key)).select(key)


def _chosen(rows: DataFrame, bars: DataFrame, key: str, assets, by_name: str | None,
            date_col: str) -> DataFrame:
    """Keep the chosen assets in ``rows``; names are looked up on the whole ``bars``."""
    if assets is None:
        return rows
    if by_name is None:
        return rows.where(F.col(key).isin(list(assets)))
    keys = keys_for_names(bars, key, by_name, assets, date_col)
    return rows.join(F.broadcast(keys), key, "left_semi")


def history(bars: DataFrame, key: str, span="1M", assets=None, by_name: str | None = None,
            date_col: str = "date") -> DataFrame:
    """Rows after ``latest - span`` (strict) with a per-asset trend color.

    ``span`` is a range label, a day count or ``CALENDAR_YTD``.
    ``assets=None`` keeps every asset; otherwise a list of keys, or of
    display names in column ``by_name``.  The color is green when the asset
    has more than one row in the range and its last close is at least its
    first close, gray otherwise.  Output: key, date, open, high, low, close,
    volume, color.

    The per-asset first/last close is an aggregate joined back on the key,
    not a window over the key, so a dominant asset is split across tasks by
    the partial aggregate and by AQE's skew handling of the join.
    """
    fine = numbers(bars)
    if span == CALENDAR_YTD:
        rows = fine.where(F.col(date_col) >= year_start_of_latest(bars, date_col))
    else:
        rows = fine.where(F.col(date_col) > days_before_latest(bars, span_days(span), date_col))
    rows = _chosen(rows, bars, key, assets, by_name, date_col)
    rows = rows.select(key, date_col, "open", "high", "low", "close", "volume")
    # several rows on one date: the whole row decides, so the color does not depend on the run
    whole = F.struct(date_col, "open", "high", "low", "close", "volume")
    stats = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(whole).getField("close").alias("_first"),
        F.max(whole).getField("close").alias("_last"),
    )
    return rows.join(stats, key, "inner").select(
        key, date_col, "open", "high", "low", "close", "volume",
        labels.trend_color("_n", "_first", "_last").alias("color"))


def open_close(bars: DataFrame, key: str, label: str, k: int = 10, days: int = 7, assets=None,
               by_name: str | None = None, date_col: str = "date") -> DataFrame:
    """Open and close of the top-``k`` assets since ``latest - days`` (strict), long form.

    Each asset gives two series, ``"<label> - Open"`` and ``"<label> - Close"``.
    Output: key, series, date, price.
    """
    top = F.broadcast(top_assets(bars, key, k, "latest", date_col=date_col).select(key))
    rows = numbers(bars).where(F.col(date_col) > days_before_latest(bars, days, date_col))
    rows = rows.join(top, key, "left_semi")
    rows = _chosen(rows, bars, key, assets, by_name, date_col)
    long = rows.select(key, label, date_col, "open", "close").unpivot(
        [key, label, date_col], ["open", "close"], "_kind", "price")
    kind = F.when(F.col("_kind") == "open", F.lit(labels.OPEN_SUFFIX)).otherwise(
        F.lit(labels.CLOSE_SUFFIX))
    return long.select(key, labels.series_name(label, kind).alias("series"), date_col, "price")
