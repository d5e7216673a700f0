import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as E
from finseries.operators import snapshot as S
from finseries.sources import store as ST

from conftest import SF0001


def _table():
    return os.path.join(tempfile.mkdtemp(prefix="fs-dates-"), "t")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dates_are_recorded_at_publish(spark, bars):
    table = _table()
    df = bars([("A", "2024-01-01", 1.0), ("A", "2024-01-03", 2.0), ("B", "2024-01-05", 3.0), ("B", "2024-01-05", 4.0)])
    holed = df.unionByName(df.limit(1).withColumn("date", F.lit(None).cast("date")))
    ST.publish(holed, table, dates="date")
    assert ST.run_dates(spark, table) == (dt.date(2024, 1, 1), dt.date(2024, 1, 5), dt.date(2024, 1, 3))
    back = S.know_dates(ST.read_curated(spark, table), *ST.run_dates(spark, table)[1:])
    plain = ST.read_curated(spark, table)
    assert S.latest_dates(back).collect() == S.latest_dates(plain).collect()
    for pick in (lambda b: S.days_before_latest(b, 2), S.year_start_of_latest):
        assert spark.range(1).select(pick(back)).first()[0] == spark.range(1).select(pick(plain)).first()[0]
    assert [r.symbol for r in S.snapshot_change(back, "symbol", "name").collect()] == [r.symbol for r in S.snapshot_change(plain, "symbol", "name").collect()]


def test_pruned_runs_lose_their_dates_and_the_newest_keeps_its_own(spark, bars):
    table = _table()
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        ST.publish(bars([("A", d, 1.0)]), table, keep=1, dates="date")
    assert ST.run_dates(spark, table) == (dt.date(2024, 1, 3), dt.date(2024, 1, 3), None)
    assert len([f for f in os.listdir(os.path.join(table, "_dates")) if f.endswith(".json") and not f.startswith(".")]) == 1
    ST.publish(bars([("A", "2024-01-04", 1.0)]), table, keep=1)  # a run without recorded dates is looked up by a scan
    assert ST.run_dates(spark, table) is None
    assert str(S.latest_dates(ST.read_curated(spark, table)).first().latest) == "2024-01-04"


def test_empty_and_undated_tables(spark, bars):
    table = _table()
    ST.publish(bars([("A", "2024-01-01", 1.0)]).where("1 = 0"), table, dates="date")
    assert ST.run_dates(spark, table) == (None, None, None)
    back = S.know_dates(ST.read_curated(spark, table), None, None)
    assert S.latest_dates(back).first() == (None, None) and S.snapshot_change(back, "symbol", "name").count() == 0


def test_published_snapshot_scans_no_dates(spark):
    plan = _plan(E.queries()["published_snapshot"](spark, SF0001))
    assert "Subquery" not in plan and plan.count("FileScan parquet") == 2
    assert _plan(E.queries()["published_sparkline"](spark, SF0001)).count("Subquery") == 0


def test_derived_tables_look_their_dates_up(spark, bars):
    df = S.know_dates(bars([("A", "2024-01-01", 1.0), ("A", "2024-01-02", 1.0)]), dt.date(2024, 1, 2), dt.date(2024, 1, 1))
    assert str(S.latest_dates(df.where("date < '2024-01-02'")).first().latest) == "2024-01-01"
