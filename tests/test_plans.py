"""Plan shape checks: the physical operators the design relies on."""

import __spark_entry__ as E
from finseries.plans import catalogue

from conftest import SF001


# queries that write and read back a table: what is left of their plan is a scan
STAGED = ("curate", "raw_csv", "stream", "vendor", "publish", "watch")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_movers_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in _plan(E.queries()["movers_top"](spark, SF001))


def test_training_cut_is_limited_per_group_before_shuffle(spark):
    plan = _plan(E.queries()["stock_training_set"](spark, SF001))
    assert plan.count("WindowGroupLimit") >= 2  # partial and final


def test_no_single_partition_window(spark):
    for name, fn in catalogue.QUERIES.items():
        if name.startswith(STAGED):
            continue
        plan = _plan(fn(spark, SF001))
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if line.strip().lstrip("+- :").startswith("Window "):
                below = "\n".join(lines[i + 1:i + 4])
                assert "SinglePartition" not in below, name


def test_latest_day_filter_reaches_the_scan(spark):
    plan = _plan(E.queries()["stock_snapshot"](spark, SF001))
    scans = [l for l in plan.splitlines() if "FileScan parquet" in l and "lineitem" in l]
    assert any("Subquery" in l for l in scans), "date filter should sit on the lineitem scan"


def test_literal_names_need_no_join(spark):
    from finseries.sources import raw as R
    df = spark.createDataFrame([("BTC",)], "symbol string")
    plan = _plan(R.with_names(df, "symbol", "crypto", {"BTC": "Bitcoin"}))
    assert "Join" not in plan


def test_rolling_mean_has_no_window_over_whole_series(spark):
    plan = _plan(E.queries()["indicator_rolling"](spark, SF001))
    windows = [l for l in plan.splitlines() if l.strip().startswith("+- Window") or l.strip().startswith("Window")]
    assert windows
    # every window that sees input rows is partitioned by (indicator, bucket)
    assert any("_b" in l for l in windows)


def test_no_nested_loop_cartesian_or_row_udf(spark):
    for name, fn in catalogue.QUERIES.items():
        if name.startswith(STAGED):
            continue
        plan = _plan(fn(spark, SF001))
        for bad in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython"):
            assert bad not in plan, (name, bad)


def test_sizing_conf_bounds():
    from finseries.session import sizing_conf
    big = sizing_conf(100 * 2 ** 40, 8000)
    assert big["spark.sql.shuffle.partitions"] == "100000"
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    assert sizing_conf(10 << 20, 8)["spark.sql.shuffle.partitions"] == "24"


def _nodes(df):
    """Every physical operator of a plan that ran, inside its query stages too."""
    stack = [df._jdf.queryExecution().executedPlan()]
    while stack:
        n = stack.pop()
        yield n
        if n.nodeName() == "AdaptiveSparkPlan":
            stack.append(n.executedPlan())
        elif n.nodeName().endswith("QueryStage"):
            stack.append(n.plan())
        children = n.children()
        stack += [children.apply(i) for i in range(children.size())]


def test_rolling_mean_shuffles_the_rows_twice(spark):
    from finseries.operators import indicators as I_
    rows = spark.range(20_000).selectExpr("'a' AS indicator", "date_add(DATE'2000-01-01', CAST(id AS INT)) AS date", "CAST(id AS DOUBLE) AS value")
    df = I_.rolling_mean(rows, None, 3, n_buckets=4)
    df.collect()
    full = [n for n in _nodes(df) if n.nodeName() == "Exchange" and n.metrics().get("shuffleRecordsWritten").get().value() >= 20_000]
    carried = len({n.id() for n in full})
    assert 1 <= carried <= 2, carried


def test_day_filter_skips_row_groups_of_a_table_sorted_by_date(spark):
    import tempfile

    from pyspark.sql import functions as F

    from finseries.operators import snapshot as S
    path = tempfile.mkdtemp(prefix="fs-prune-") + "/t"
    rows = spark.range(0, 60_000, 1, 1).selectExpr("date_add(DATE'2000-01-01', CAST(id / 100 AS INT)) AS date", "'x' AS symbol", "1.0D AS close")
    rows.sortWithinPartitions("date").write.option("maxRecordsPerFile", 6_000).parquet(path)
    bars = spark.read.parquet(path)

    def scanned(df):
        df.collect()
        return max(n.metrics().get("numOutputRows").get().value() for n in _nodes(df) if n.nodeName().startswith("Scan parquet") and "close" in n.simpleString(200))

    literal = scanned(bars.where(F.col("date") > F.lit("2001-07-24").cast("date")).select("close"))
    bound = scanned(bars.where(F.col("date") > S.days_before_latest(bars, 29)).select("close"))
    assert literal < 60_000 and 0 < bound <= literal + 6_000, (literal, bound)


def test_bar_view_needs_no_sort_aggregate(spark):
    from finseries.sources import adapters as A
    assert "SortAggregate" not in _plan(A.long_bars(spark, SF001))


def test_snapshot_scans_the_bars_twice_besides_the_dates(spark):
    plan = _plan(E.queries()["stock_snapshot"](spark, SF001))
    main = plan.split("Subquery")[0] if plan.startswith("Subquery") else plan
    scans = [line for line in main.splitlines() if "FileScan parquet" in line and "l_extendedprice" in line]
    assert len(scans) <= 2, len(scans)


def test_latest_dates_take_one_scan(spark):
    assert _plan(E.queries()["latest_dates"](spark, SF001)).count("FileScan parquet") == 2  # lineitem and part, once each


def test_declared_schemas_are_those_of_the_files(spark):
    from finseries.sources import adapters as A
    for name in A.SCHEMAS:
        inferred = spark.read.parquet(f"{SF001}/{name}.parquet").schema
        assert A.table(spark, SF001, name).schema == inferred, name


def test_views_see_appended_files(spark):
    import shutil
    import tempfile

    from finseries.sources import adapters as A
    root = tempfile.mkdtemp(prefix="fs-fresh-")
    for t in ("events",):
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(100).write.parquet(f"{root}/{t}.parquet")
    first = A.tick_bars(spark, root).agg({"volume": "sum"}).first()[0]
    spark.read.parquet(f"{SF001}/events.parquet").limit(50).write.mode("append").parquet(f"{root}/events.parquet")
    assert A.tick_bars(spark, root).agg({"volume": "sum"}).first()[0] == first + 50
    shutil.rmtree(root)
