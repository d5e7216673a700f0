"""Latest-day questions: latest dates, top assets, snapshot change, sparkline.

"Latest" is one date for the whole table (an asset that lags drops out).
Every date bound is one scalar subquery that returns the finished date, which
Spark runs once per query.  A filter ``date >= <subquery>`` on a bar table is
pushed below aggregates and joins down to the scan: it prunes the partitions
of a table partitioned by date, and skips row groups of a table sorted by it.
"""

from __future__ import annotations

import datetime as dt
import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finseries.functions import labels
from finseries.functions.parse import numbers


_BOUNDS: "weakref.WeakKeyDictionary[DataFrame, dict]" = weakref.WeakKeyDictionary()


def _bound(bars: DataFrame, date_col: str, name: str, value) -> Column:
    """Scalar subquery that returns a finished DATE, built once per bar DataFrame and name.

    Comparing a column with the bare subquery (no arithmetic, no struct field
    around it) lets Spark put its value into the scan's pushed filters, so
    row groups outside the bound are skipped.
    """
    per = _BOUNDS.setdefault(bars, {})
    if (date_col, "known") in per and (date_col, name) not in per:
        latest, prev = per[date_col, "known"]
        day = {"latest": latest, "prev": prev, "year": latest and latest.replace(month=1, day=1)}
        known = day[name] if name in day else latest and latest + dt.timedelta(days=int(name))
        per[date_col, name] = F.lit(known).cast("date")
    if (date_col, name) not in per:
        per[date_col, name] = value(bars.select(F.col(date_col).alias("_d")).where(F.col("_d").isNotNull())).scalar()
    return per[date_col, name]


def know_dates(bars: DataFrame, latest: dt.date | None, prev: dt.date | None, date_col: str = "date") -> DataFrame:
    """``bars`` with its two newest dates told (as recorded at publish): its date bounds become literals, without a scan.

    Only this DataFrame knows them; one that is derived from it looks them up again.
    """
    _BOUNDS.setdefault(bars, {})[date_col, "known"] = (latest, prev)
    return bars


def latest_date(bars: DataFrame, date_col: str = "date") -> Column:
    """Scalar subquery: the greatest date of the table."""
    return _bound(bars, date_col, "latest", lambda d: d.agg(F.max("_d")))


def previous_date(bars: DataFrame, date_col: str = "date") -> Column:
    """Scalar subquery: the greatest date below the latest one.

    One pass: a partial distinct per task (a few thousand dates at most),
    then the top two; NULL if there is only one date.
    """
    def second(d: DataFrame) -> DataFrame:
        top2 = d.distinct().orderBy(F.desc("_d")).limit(2)
        return top2.agg(F.when(F.count(F.lit(1)) == 2, F.min("_d")))
    return _bound(bars, date_col, "prev", second)


def days_before_latest(bars: DataFrame, days: int, date_col: str = "date") -> Column:
    """Scalar subquery: the latest date minus ``days``."""
    return _bound(bars, date_col, f"-{int(days)}", lambda d: d.agg(F.date_sub(F.max("_d"), int(days))))


def year_start_of_latest(bars: DataFrame, date_col: str = "date") -> Column:
    """Scalar subquery: January 1 of the latest date's year."""
    return _bound(bars, date_col, "year", lambda d: d.agg(F.trunc(F.max("_d"), "year")))


def latest_dates(bars: DataFrame, date_col: str = "date") -> DataFrame:
    """One row: ``latest``, ``prev`` (NULL if there is only one date); literals where the dates are known, else one scan."""
    if (date_col, "known") in _BOUNDS.get(bars, {}):
        return bars.sparkSession.range(1).select(latest_date(bars, date_col).alias("latest"), previous_date(bars, date_col).alias("prev"))
    days = bars.select(F.col(date_col).alias("_d")).where(F.col("_d").isNotNull()).distinct()
    return days.orderBy(F.desc("_d")).limit(2).agg(F.max("_d").alias("latest"), F.when(F.count(F.lit(1)) == 2, F.min("_d")).alias("prev"))


def top_assets(bars: DataFrame, key: str, k: int = 10, scope: str = "latest",
               by: str = "rows", date_col: str = "date") -> DataFrame:
    """The ``k`` keys with the most rows (or volume), ties by key.

    ``scope="latest"`` counts rows on the latest date only, ``"all"`` over all
    history.  Rows without a key are left out.  Output: key, ``count`` (or
    ``volume``).  The result has at most ``k`` rows, so it can be broadcast.
    """
    rows = bars.where(F.col(key).isNotNull())
    if scope == "latest":
        rows = rows.where(F.col(date_col) == latest_date(bars, date_col))
    elif scope != "all":
        raise ValueError(f"scope must be 'latest' or 'all', not {scope!r}")
    if by == "rows":
        measure = F.count(F.lit(1)).alias("count")
        order = "count"
    elif by == "volume":
        measure = F.sum("volume").alias("volume")
        order = "volume"
    else:
        raise ValueError(f"by must be 'rows' or 'volume', not {by!r}")
    return rows.groupBy(key).agg(measure).orderBy(F.desc(order), F.asc(key)).limit(k)


def top_assets_named(bars: DataFrame, key: str, name: str, k: int = 10,
                     date_col: str = "date") -> DataFrame:
    """Top keys on the latest date with their distinct names from that date."""
    top = top_assets(bars, key, k, "latest", date_col=date_col)
    latest_names = (bars.where(F.col(date_col) == latest_date(bars, date_col))
                    .select(key, name).distinct())
    return top.join(latest_names, key, "inner")


def snapshot_change(bars: DataFrame, key: str, name: str, k: int = 10,
                    date_col: str = "date") -> DataFrame:
    """Latest against previous day for the top ``k`` assets of the latest day.

    Inner join on ``key``: an asset missing on either day drops out.  The
    previous day is one row per asset (mean close if the asset has several
    rows that day), so every latest-day row appears once and the output is
    never larger than the latest day's rows: repeated rows of one asset do
    not pair up with each other.  Output: key, name, open_curr, close_curr,
    close_prev, pct_change, arrow, color.

    One aggregate over the rows since the previous day (these are the two
    days) gives the latest-day counts, the top list and the previous closes;
    its at most ``k`` rows are broadcast to the latest day's rows.
    """
    fine = numbers(bars)
    latest = latest_date(bars, date_col)
    both = fine.where((F.col(date_col) >= previous_date(bars, date_col)) & F.col(key).isNotNull())
    today = F.col(date_col) == latest
    per_asset = both.groupBy(key).agg(
        F.count(F.when(today, 1)).alias("_n"), F.count(F.when(~today, 1)).alias("_np"),
        F.avg(F.when(~today, F.col("close"))).alias("close_prev"))
    top = per_asset.where("_n > 0").orderBy(F.desc("_n"), F.asc(key)).limit(k).where("_np > 0").select(key, "close_prev")
    cur = fine.where(F.col(date_col) == latest).select(
        key, F.col(name).alias(name), F.col("open").alias("open_curr"), F.col("close").alias("close_curr"))
    j = cur.join(F.broadcast(top), key, "inner")
    return j.select(
        key, name, "open_curr", "close_curr", "close_prev",
        labels.pct_change("close_curr", "close_prev").alias("pct_change"),
        labels.arrow("close_curr", "close_prev").alias("arrow"),
        labels.change_color("close_curr", "close_prev").alias("color"),
    )


def sparkline(bars: DataFrame, key: str, name: str, k: int = 10, days: int = 7,
              date_col: str = "date") -> DataFrame:
    """Closes of each snapshot asset since ``latest - days`` (inclusive).

    One series per snapshot asset and color.  Output: key, date, close, color.
    """
    # at most k keys and two colors per key: a bounded broadcast side
    snap = snapshot_change(bars, key, name, k, date_col).select(key, "color").distinct()
    since = days_before_latest(bars, days, date_col)
    recent = numbers(bars).where(F.col(date_col) >= since).select(key, date_col, "close")
    return recent.join(F.broadcast(snap), key, "inner").select(key, date_col, "close", "color")
