import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from finseries.sources import store as ST

SCHEMA = "symbol string, date date, close double"


def _table():
    return os.path.join(tempfile.mkdtemp(prefix="fs-versions-"), "t")


def _rows(spark, **closes):
    return spark.createDataFrame([(k.replace("_", "#"), float(c)) for k, cs in closes.items() for c in cs], "symbol string, close double").selectExpr(
        "symbol", "DATE'2024-01-01' AS date", "close")


def _codes(spark, *codes):
    return spark.createDataFrame([(c,) for c in codes], "symbol string")


def _got(spark, table):
    return sorted(((r.symbol, r.close) for r in ST.read_curated(spark, table).collect()), key=lambda x: (x[0] or "", x[1]))


def _files(run):
    return sorted(os.path.relpath(f, run) for f in glob.glob(f"{run}/**/*.parquet", recursive=True))


def test_only_the_changed_codes_are_written(spark):
    table = _table()
    ST.publish_changed(_rows(spark, A=range(3000), B=range(3000), C_1=[5.0]), table, "symbol", sort_within=["date"])
    run = ST.publish_changed(_rows(spark, B=[7.0]), table, "symbol", _codes(spark, "B"))
    files = _files(run)
    assert files and all(f.startswith("symbol=B/") for f in files)
    assert sum(os.path.getsize(os.path.join(run, f)) for f in files) < 2_000
    got = ST.read_curated(spark, table)
    assert got.columns == ["symbol", "date", "close"] and got.dtypes == _rows(spark, A=[1.0]).dtypes
    assert [x for x in _got(spark, table) if x[0] != "A"] == [("B", 7.0), ("C#1", 5.0)] and got.where("symbol = 'A'").count() == 3000


def test_codes_come_go_and_come_back(spark):
    table = _table()
    ST.publish_changed(_rows(spark, A=[1.0], B=[2.0]), table, "symbol")
    ST.publish_changed(_rows(spark, C=[3.0]), table, "symbol", _codes(spark, "A", "C"))
    assert _got(spark, table) == [("B", 2.0), ("C", 3.0)]
    ST.publish_changed(_rows(spark, A=[4.0]), table, "symbol", _codes(spark, "A"))
    ST.publish_changed(spark.createDataFrame([], SCHEMA), table, "symbol", _codes(spark, "C"))
    assert _got(spark, table) == [("A", 4.0), ("B", 2.0)]
    ST.publish_changed(spark.createDataFrame([], SCHEMA), table, "symbol", _codes(spark, "A", "B"))
    assert _got(spark, table) == []


def test_a_failed_load_leaves_the_old_version(spark):
    table = _table()
    ST.publish_changed(_rows(spark, A=[1.0], B=[2.0]), table, "symbol")
    bad = _rows(spark, A=[9.0]).withColumn("close", F.when(F.col("close") > 0, F.raise_error(F.lit("boom")).cast("double")).otherwise(0.0))
    with pytest.raises(Exception):
        ST.publish_changed(bad, table, "symbol", _codes(spark, "A"))
    assert _got(spark, table) == [("A", 1.0), ("B", 2.0)]
    ST.publish_changed(_rows(spark, A=[3.0]), table, "symbol", _codes(spark, "A"))
    assert _got(spark, table) == [("A", 3.0), ("B", 2.0)]


def test_an_open_reader_keeps_its_version(spark):
    table = _table()
    ST.publish_changed(_rows(spark, A=[1.0], B=[2.0]), table, "symbol")
    before = ST.read_curated(spark, table)
    ST.publish_changed(_rows(spark, A=[3.0]), table, "symbol", _codes(spark, "A"), keep=2)
    assert sorted((r.symbol, r.close) for r in before.collect()) == [("A", 1.0), ("B", 2.0)]


def test_pruning_deletes_a_file_once_no_kept_version_names_it(spark):
    table = _table()
    ST.publish_changed(_rows(spark, A=[1.0], B=[2.0]), table, "symbol")
    for i in range(4):
        ST.publish_changed(_rows(spark, A=[10.0 + i]), table, "symbol", _codes(spark, "A"), keep=2)
    assert len(ST.complete_runs(spark, table)) == 2 and _got(spark, table) == [("A", 13.0), ("B", 2.0)]
    files = [f for f in glob.glob(f"{table}/run=*/**/*.parquet", recursive=True)]
    assert sorted(os.path.basename(os.path.dirname(f)) for f in files) == ["symbol=A", "symbol=A", "symbol=B"]
    ST.publish_changed(_rows(spark, A=[1.0], B=[5.0]), table, "symbol", keep=1)  # nothing carried over: the rest goes
    assert len(glob.glob(f"{table}/run=*")) == 1 and _got(spark, table) == [("A", 1.0), ("B", 5.0)]


def test_null_codes(spark):
    table = _table()
    rows = spark.createDataFrame([(None, 1.0), ("A", 2.0)], "symbol string, close double")
    ST.publish_changed(rows, table, "symbol")
    ST.publish_changed(rows.where("symbol = 'A'").withColumn("close", F.lit(3.0)), table, "symbol", _codes(spark, "A"))
    assert _got(spark, table) == [(None, 1.0), ("A", 3.0)]
    ST.publish_changed(rows.where("1 = 0"), table, "symbol", _codes(spark, None))
    assert _got(spark, table) == [("A", 3.0)]
