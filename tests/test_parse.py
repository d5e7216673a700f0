import pytest
from pyspark.sql import functions as F

from finseries.functions.parse import percent_to_number, strict_date, to_number


def _one(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    return [r[0] for r in df.select(fn("s")).collect()]


def test_bad_numbers_are_null(spark):
    assert _one(spark, ["abc", "", "1,000", "nan", "1.5d", "0x1p3", "NaN", None], to_number) == [None] * 8


def test_good_numbers(spark):
    assert _one(spark, [" 5.5 ", "1e3", "-2", ".5", "+3.", "1.0E7"], to_number) == [5.5, 1000.0, -2.0, 0.5, 3.0, 1e7]


def test_infinity_forms(spark):
    got = _one(spark, ["inf", "-Infinity", " +INF "], to_number)
    assert got == [float("inf"), float("-inf"), float("inf")]


def test_percent_text(spark):
    assert _one(spark, ["12.5%", "n/a", "3", "%"], percent_to_number) == [12.5, None, 3.0, None]


def test_strict_date_accepts_and_keeps_null(spark):
    import datetime as dt
    assert _one(spark, ["2024-01-05", None], strict_date) == [dt.date(2024, 1, 5), None]


def test_strict_date_raises(spark):
    df = spark.createDataFrame([("2024-13-01",)], "s string")
    with pytest.raises(Exception):
        df.select(strict_date("s")).collect()


def test_nan_never_passes_a_positive_test(spark):
    df = spark.createDataFrame([("nan",)], "s string").select(to_number("s").alias("x"))
    assert df.where(F.col("x") > 0).count() == 0


def test_strict_date_raises_without_ansi_too(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("2024-13-01",)], "s string")
        with pytest.raises(Exception):
            df.select(strict_date("s")).collect()
        assert _one(spark, ["1,000", "nan"], to_number) == [None, None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
