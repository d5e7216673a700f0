"""Calendar columns, year-over-year view, rolling means, sorted value lists."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finseries.functions.parse import numbers


def calendar_columns(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add year, month, month_name (short English name) and year_month (month start)."""
    d = F.col(date_col)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMM"),
        "year_month": F.trunc(d, "MM"),
    })


def yoy(ind: DataFrame, indicators: Iterable[str] | None = None,
        years: Iterable[int] = (2023, 2024), key: str = "indicator",
        date_col: str = "date") -> DataFrame:
    """One row per input row of the chosen indicators in the chosen years.

    Output: key, legend (the year as text), year, month, month_name, date,
    value.  Sort by ``month`` for calendar order of ``month_name``.
    """
    rows = calendar_columns(ind, date_col)
    cond = F.col("year").isin([int(y) for y in years])
    if indicators is not None:
        cond = cond & F.col(key).isin(list(indicators))
    return rows.where(cond).select(
        key, F.col("year").cast("string").alias("legend"), "year", "month", "month_name",
        date_col, "value")


def sorted_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-missing values of one column, sorted."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def _range_buckets(rows: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    """Add ``_tb`` (tie-break) and ``_b`` (bucket): contiguous, balanced runs
    of each series in (order, _tb) order.

    Range partitioning on (key, *order, _tb) samples the data and cuts it at
    balanced bounds, so a dominant series, day or group of identical rows is
    spread over several buckets (the row id splits identical copies).  The
    partition number is the bucket; buckets of one series are in order.

    Rows are sorted inside each input partition before the row id is taken,
    so a recomputed task gives every row the same id again (identical rows
    may swap ids, which changes nothing): the buckets are the same in every
    branch of the plan and after a lost executor.
    """
    cols = [key, *order]
    tagged = rows.sortWithinPartitions(*cols).withColumn("_tb", F.monotonically_increasing_id())
    ranged = tagged.repartitionByRange(n, *cols, "_tb")
    return ranged.withColumn("_b", F.spark_partition_id())


def rolling_mean(ind: DataFrame, indicators: Iterable[str] | None = None, window: int = 3,
                 key: str = "indicator", date_col: str = "date", value_col: str = "value",
                 bucket: Column | None = None, n_buckets: int | None = None,
                 digits: int | None = None) -> DataFrame:
    """Mean of the last ``window`` rows per series in date order.

    The mean is NULL until ``window`` rows are in the frame, and a missing
    value anywhere in the frame makes it NULL.  Rows without a series key are
    left out.  Ties on the date are ordered
    by value.  The frame is summed oldest first, ``((v[-2] + v[-1]) + v[0])``,
    so the result does not depend on how the work was split.  Output: key,
    date, value, rolling_avg.

    A window partitioned by the series alone would put a whole series into
    one task.  Instead each series is cut into buckets: by default balanced
    range partitions (``n_buckets``, default the shuffle partition count), or
    a given ``bucket`` column such as the calendar year.  Previous values are
    lags inside each (series, bucket); the first ``window - 1`` rows of a
    bucket take the values before the bucket start from a carry table (one row
    per series and bucket, with the last values of earlier buckets).  Rows are
    shuffled twice: by range, and by (series, bucket).
    """
    w = int(window)
    if w < 1:
        raise ValueError("window must be at least 1")
    # rows without a series are never chosen (as in a selection by name)
    rows = ind.where(F.col(key).isNotNull())
    if indicators is not None:
        rows = rows.where(F.col(key).isin(list(indicators)))
    rows = numbers(rows.select(key, date_col, value_col))
    if bucket is None:
        n = n_buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = _range_buckets(rows, key, [date_col, value_col], n)
        order = [date_col, value_col, "_tb"]
    else:
        rows = rows.withColumn("_b", bucket)
        order = [date_col, value_col]

    part = Window.partitionBy(key, "_b")
    ordered = part.orderBy(*order)
    local = rows.select(
        key, date_col, value_col, "_b",
        F.row_number().over(ordered).alias("_rn"),
        F.count(F.lit(1)).over(part).alias("_nb"),
        *[F.lag(value_col, d).over(ordered).alias(f"_l{d}") for d in range(1, w)],
    )
    if w == 1:
        values = [F.col(value_col)]
        done = local
    else:
        # one row per series and bucket: its last w - 1 values, then those before it
        tails = local.where(F.col("_rn") > F.col("_nb") - (w - 1)).groupBy(key, "_b").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("_rn", F.col(value_col).alias("v")))), lambda x: x["v"]).alias("_tail"))
        earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(-(w - 1), -1)
        carry = tails.select(key, "_b", F.flatten(F.collect_list("_tail").over(earlier)).alias("_before"))
        # both sides are split by (series, bucket) already: no shuffle of the rows
        done = local.join(carry, [key, "_b"], "inner")
        back = F.size("_before")
        values = [F.col(value_col)] + [
            F.when(F.col("_rn") > d, F.col(f"_l{d}")).otherwise(F.when(
                back >= d + 1 - F.col("_rn"), F.try_element_at("_before", F.col("_rn") - (d + 1))))
            for d in range(1, w)]
    total = values[-1]
    for v in reversed(values[:-1]):
        total = total + v
    avg = total / F.lit(float(w))
    if digits is not None:
        avg = F.round(avg, digits)
    return done.select(key, date_col, value_col, avg.alias("rolling_avg"))


def rolling_mean_exact(ind: DataFrame, indicators: Iterable[str] | None = None, window: int = 200,
                       key: str = "indicator", date_col: str = "date", value_col: str = "value",
                       n_buckets: int | None = None, digits: int = 4) -> DataFrame:
    """``rolling_mean`` for any width: plan, shuffles and work per row do not depend on ``window``.

    Values are taken as whole numbers of ``10 ** -digits`` (rounded half away
    from zero).  Their sums are exact, so a frame's sum is the difference of
    two prefix sums.  The mean is NULL until ``window`` rows are in the frame
    and where the frame holds a missing value; NaN, infinity and numbers of
    more than 20 digits count as missing.  Rows without a series key are left
    out, ties on the date are ordered by value, and repeated rows are rows of
    their own.  Output: key, date, value, rolling_avg.

    Prefix sums have two levels: inside balanced range buckets (``n_buckets``,
    default the shuffle partition count), and over the buckets' totals, one row
    per series and bucket.  Each row then meets the prefix sums ``window``
    places earlier in a join on (series, place), a key without repeats, so a
    hot series is spread over all tasks.
    """
    w = int(window)
    if w < 1:
        raise ValueError("window must be at least 1")
    rows = ind.where(F.col(key).isNotNull())
    if indicators is not None:
        rows = rows.where(F.col(key).isin(list(indicators)))
    rows = numbers(rows.select(key, date_col, value_col))
    n = n_buckets or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    units = F.round(F.col(value_col) * F.lit(10.0 ** digits)).try_cast("decimal(20,0)")
    rows = _range_buckets(rows, key, [date_col, value_col], n).withColumn("_u", units)

    zero = F.lit(0).cast("decimal(38,0)")
    ordered = Window.partitionBy(key, "_b").orderBy(date_col, value_col, "_tb").rowsBetween(Window.unboundedPreceding, 0)
    local = rows.select(key, date_col, value_col, "_b", F.count(F.lit(1)).over(ordered).alias("_n"),
                        F.count("_u").over(ordered).alias("_f"), F.coalesce(F.sum("_u").over(ordered).cast("decimal(38,0)"), zero).alias("_s"))
    ends = rows.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"), F.count("_u").alias("_f"), F.sum("_u").cast("decimal(38,0)").alias("_s"))
    earlier = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.select(key, "_b", *(F.coalesce(F.sum(c).over(earlier).cast(t), F.lit(0).cast(t)).alias(f"{c}0")
                                     for c, t in (("_n", "long"), ("_f", "long"), ("_s", "decimal(38,0)"))))
    # both sides are split by (series, bucket) already: no shuffle of the rows
    sums = local.join(carry, [key, "_b"], "inner").select(
        key, date_col, value_col, (F.col("_n") + F.col("_n0")).alias("_at"), (F.col("_f") + F.col("_f0")).alias("_f"),
        (F.col("_s") + F.col("_s0")).cast("decimal(38,0)").alias("_s"))
    before = sums.select(key, (F.col("_at") + w).alias("_at"), F.col("_f").alias("_f0"), F.col("_s").alias("_s0"))
    done = sums.join(before, [key, "_at"], "left")
    full = (F.col("_at") >= w) & (F.col("_f") - F.coalesce("_f0", F.lit(0)) == w)
    total = (F.col("_s") - F.coalesce("_s0", zero)).cast("double")
    return done.select(key, date_col, value_col, F.when(full, total / F.lit(w * 10.0 ** digits)).alias("rolling_avg"))
